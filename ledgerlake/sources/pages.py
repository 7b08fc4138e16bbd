"""Landed API pages: unwrap their envelopes and reconcile what arrived with what was announced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Where an envelope keeps its items, and where it announces their number.
ITEM_KEYS = ("itens", "items", "dados", "data")
TOTAL_KEYS = ("itens_totais", "totalItems", "total_itens", "total")


def read_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Landed responses as ``source_file, body``: one per file, or one per line."""
    text = spark.read.text(path, wholetext=not lines)
    return text.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("body"))


def _fields(body: Column) -> Column:
    """Top-level fields of a JSON object, each as JSON text: the page is parsed once."""
    return F.from_json(body, "map<string,string>")


def _listed(text: Column) -> Column:
    return F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))


def items_of(fields: Column, body: Column, shape: str = "page", filled: tuple[str, ...] = ()) -> Column:
    """Items as JSON texts: of an envelope, a bare list or one object.

    Of an envelope the first known key that is present counts, and a null there is no items; an envelope without
    such a key has none. ``filled`` names the keys of an endpoint whose first list that is not empty counts instead.
    ``shape`` is page, list or single.
    """
    if shape == "single":
        return F.array(body)
    bare, none = F.ltrim(body).startswith("["), F.array().cast("array<string>")
    if shape == "list":
        return F.when(bare, _listed(body)).otherwise(none)
    held: Column = none
    for key in reversed(filled or ITEM_KEYS):
        here = fields[key].rlike(r"^\s*\[\s*[^\s\]]") if filled else F.map_contains_key(fields, key)
        held = F.when(here, _listed(fields[key])).otherwise(held)
    return F.when(bare, _listed(body)).otherwise(held)


def announced_total(fields: Column) -> Column:
    """The number of items the endpoint says it has, under whichever name it uses."""
    nested = F.get_json_object(fields["paginacao"], "$.total_itens")
    return F.coalesce(*[fields[k] for k in TOTAL_KEYS], nested).try_cast("bigint")


def open_pages(pages: DataFrame, shape: str = "page", filled: tuple[str, ...] = ()) -> DataFrame:
    """Add ``items`` (array of JSON texts) and ``announced`` to pages with a ``body``."""
    is_object = ~F.ltrim(F.col("body")).startswith("[")
    # The generator keeps the parsed fields a column of their own, so the page is parsed once.
    parsed = pages.select("*", F.explode(F.array(F.when(is_object, _fields(F.col("body"))))).alias("_fields"))
    return parsed.select(
        *pages.columns,
        items_of(F.col("_fields"), F.col("body"), shape, filled).alias("items"),
        announced_total(F.col("_fields")).alias("announced"),
    )


def unwrap_pages(pages: DataFrame, shape: str = "page", filled: tuple[str, ...] = ()) -> DataFrame:
    """One row per item: the page's other columns, ``position`` on the page and ``item`` as JSON text."""
    rest = [c for c in pages.columns if c != "body"]
    return open_pages(pages, shape, filled).select(*rest, F.posexplode("items").alias("position", "item"))


def until_repeat(pages: DataFrame, by: str = "endpoint", page: str = "page", key: str = "$.id") -> DataFrame:
    """Pages of each endpoint up to its first repeated one: an endpoint that ignores the page number gives the same items for ever.

    A page's fingerprint is made of its item keys in any order. Pages without items repeat nothing. Only fingerprints are shuffled to
    find the repeats; one number per endpoint comes back.
    """
    keys = F.array_sort(F.transform(F.col("items"), lambda i: F.coalesce(F.get_json_object(i, key), F.sha2(i, 256))))
    marked = open_pages(pages).select(by, page, F.sha2(F.to_json(F.struct(keys.alias("k"))), 256).alias("_print"), F.size("items").alias("_n"))
    firsts = marked.where("_n > 0").groupBy(by, "_print", page).count()
    place = F.row_number().over(Window.partitionBy(by, "_print").orderBy(page))
    stop = firsts.withColumn("_place", place).where("_place = 2").groupBy(by).agg(F.min(page).alias("_stop"))
    return pages.join(stop, by, "left").where(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop")


def complete_endpoints(pages: DataFrame, by: str = "endpoint", page: str = "page") -> tuple[DataFrame, DataFrame]:
    """Pages, cut at the first repeat, of endpoints that delivered what they announced; and the reconciliation of those that fell short.

    An endpoint that announces nothing cannot fall short.
    """
    cut = until_repeat(pages, by, page)
    report = reconcile_pages(cut, by, page)
    short = report.where("status = 'short'")
    return cut.join(short.select(by), by, "left_anti"), short


def reconcile_pages(
    pages: DataFrame, by: str = "endpoint", page: str = "page", key: str = "$.id"
) -> DataFrame:
    """Per endpoint: items announced (by the first page that says so), received, distinct and missing.

    Pages are parsed once. Items are counted per endpoint and key first, so an endpoint with a third of
    all items is spread over its keys; the second step sees one row per distinct key.
    """
    said = F.when(F.col("announced").isNotNull(), F.col(page))
    unfolded = open_pages(pages).select(
        by, "announced", said.alias("_said"), F.posexplode_outer("items").alias("_pos", "item")
    )
    per_key = (
        unfolded.withColumn("_key", F.get_json_object("item", key))
        .groupBy(by, "_key")
        .agg(
            F.count("_pos").alias("n"),
            F.count_if(F.coalesce("_pos", F.lit(0)) == 0).alias("pages"),
            F.min_by("announced", "_said").alias("announced"),
            F.min("_said").alias("_said"),
        )
    )
    totals = per_key.groupBy(by).agg(
        F.sum("pages").alias("pages"),
        F.min_by("announced", "_said").alias("expected"),
        F.sum("n").alias("received"),
        F.count("_key").alias("distinct_items"),
    )
    missing = F.when(
        F.col("expected").isNotNull(), F.greatest(F.col("expected") - F.col("distinct_items"), F.lit(0))
    )
    return totals.select(
        by,
        "pages",
        "expected",
        "received",
        "distinct_items",
        missing.alias("missing"),
        F.when(F.col("expected").isNull(), "unknown")
        .when(missing > 0, "short")
        .when(F.col("received") > F.col("distinct_items"), "repeated")
        .otherwise("complete")
        .alias("status"),
    )

"""Change-driven reads: which parents changed, which children follow, which ids a record names."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlake.functions.time import instant
from ledgerlake.session import shared_dir

#: Levels of a record that one round of the id scan unfolds.
LEVELS = 12


def changed_keys(
    parents: DataFrame | Sequence[DataFrame],
    key: str = "id",
    changed_at: str = "data_alteracao",
    since: datetime | str | None = None,
    newest_first: bool | None = None,
) -> DataFrame:
    """Keys of the parents changed after ``since`` (all of them without one), over one or more tables.

    ``newest_first`` sorts by change time (True: newest first, False: oldest first, NULL times last in
    both); leave it None when the keys only feed a join.
    """
    tables = [parents] if isinstance(parents, DataFrame) else list(parents)
    slim = [p.select(F.col(key), F.col(changed_at)) for p in tables]
    keys = reduce(DataFrame.unionByName, slim)
    if since is not None:
        keys = keys.where(F.col(changed_at) > instant(since))
    if newest_first is None:
        return keys
    column = F.col(changed_at)
    return keys.orderBy(column.desc_nulls_last() if newest_first else column.asc_nulls_last(), key)


def follow(detail: DataFrame, keys: DataFrame, on: str, key: str = "id") -> DataFrame:
    """Detail rows whose parent is among the changed keys.

    The keys are made distinct first (map-side), so a parent that changed very often is one row.
    """
    return detail.join(keys.select(F.col(key).alias(on)).distinct(), on, "left_semi")


def with_parent(
    child: DataFrame, parent: DataFrame, on: Sequence[str], columns: Sequence[str], overwrite: bool = False
) -> DataFrame:
    """Copy parent columns into the child: always, or only where the child has none.

    A child without a parent row stays, with NULL or its own values.
    """
    renamed = parent.select(*on, *[F.col(c).alias(f"_parent_{c}") for c in columns])
    joined = child.join(renamed, list(on), "left")
    has = set(child.columns)
    out = {
        c: F.col(f"_parent_{c}") if overwrite or c not in has else F.coalesce(c, f"_parent_{c}")
        for c in columns
    }
    return joined.withColumns(out).drop(*[f"_parent_{c}" for c in columns])


def scan_ids(
    df: DataFrame,
    json_column: str,
    single: str = "cobranca",
    many: str = "cobrancas",
    direct: str = "id_cobranca",
    levels: int = LEVELS,
    max_depth: int | None = None,
) -> DataFrame:
    """Distinct ids that JSON records name at any depth.

    A hit is ``single: {id}``, every ``{id}`` in a list under ``many``, or a value under ``direct``;
    hits are not searched further, everything else is. Each record is parsed once to a VARIANT. What is still to be
    searched is a frontier: a round unfolds it by ``levels`` levels and stores the ids found and the next frontier, until that is empty. So
    the plan of a round is the same however deep a record is, and a deep record costs rounds over itself alone. Ids are
    shuffled once, to make them distinct. With ``max_depth``, a record nested deeper raises.
    """
    spark = df.sparkSession
    row = "struct<found:string,key:string,value:variant>"
    none, no_value = F.lit(None).cast("string"), F.lit(None).cast("variant")

    def text_at(v: Column, path: str) -> Column:
        """The value as text; NULL for the JSON values that count as no id."""
        written = F.to_json(F.try_variant_get(v, path, "variant"))
        return F.when(~written.isin('""', "0", "false", "null", "{}", "[]"), F.try_variant_get(v, path, "string"))

    key, value = F.col("key"), F.col("value")
    listed = F.try_variant_get(value, "$", "array<variant>")
    fields = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    own_id, direct_id = text_at(value, "$.id"), text_at(value, "$")

    def hit(found: Column) -> Column:
        return F.struct(found, none, no_value).cast(row)

    following = (
        F.when(F.col("found").isNotNull(), F.array(hit(F.col("found"))))
        .when((key == single) & own_id.isNotNull(), F.array(hit(own_id)))
        .when((key == many) & listed.isNotNull(), F.transform(listed, lambda x: hit(text_at(x, "$.id"))))
        .when((key == direct) & direct_id.isNotNull(), F.array(hit(direct_id)))
        .otherwise(
            F.coalesce(
                F.transform(fields, lambda e: F.struct(none, e["key"], e["value"]).cast(row)),
                F.transform(listed, lambda x: F.struct(none, none, x).cast(row)),
            )
        )
    )
    frontier = df.where(F.col(json_column).isNotNull()).select(
        none.alias("found"), none.alias("key"), F.parse_json(json_column).alias("value")
    )
    paths: list[str] = []
    depth = 0
    while True:
        step = levels if max_depth is None else max(1, min(levels, max_depth + 2 - depth))
        depth += step
        for _ in range(step):
            frontier = frontier.select(F.inline(following))
        # a row without an id and without a value was no hit
        left = frontier.where("found is not null or value is not null")
        seen = Observation()
        paths.append(shared_dir(spark, "id-scan"))
        left.observe(seen, F.count_if(F.col("found").isNull()).alias("open")).write.parquet(paths[-1])
        if not seen.get["open"]:
            break
        if max_depth is not None and depth >= max_depth + 2:
            raise ValueError(f"record nested deeper than {max_depth} levels")
        frontier = spark.read.schema(left.schema).parquet(paths[-1]).where("found is null")
    return spark.read.schema("found string").parquet(*paths).where("found is not null").select(F.col("found").alias("id")).distinct()

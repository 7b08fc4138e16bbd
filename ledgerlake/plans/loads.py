"""The three jobs of a tenant run: load an entity, build the models, check them.

Each job reads tables, declares one DataFrame and writes one table; Spark does the rest. The driver
only sees watermarks, row counts and check results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.keys import fill_uuid5, uuid5_key
from ledgerlake.functions.time import instant
from ledgerlake.operators.lines import invoice_item_parts, line_number, opening_balance_parts, sale_item_parts
from ledgerlake.operators.quality import not_null, run_checks, singleton, unique
from ledgerlake.operators.runlog import counted
from ledgerlake.operators.upsert import latest_by_few
from ledgerlake.operators.watermark import (
    WATERMARK_KEYS,
    WATERMARK_SCHEMA,
    get_watermark,
    in_window,
    watermark_row,
    window_bounds,
)
from ledgerlake.operators.windows import changed_since, rolling_window
from ledgerlake.plans.registry import MODELS, Model
from ledgerlake.session import shared_dir
from ledgerlake.sources.entities import ENTITIES, Entity
from ledgerlake.sources.parse import parse_entity, split_valid
from ledgerlake.sources.tables import (
    changed_after,
    ensure_database,
    ensure_table,
    last_change,
    materialize,
    read,
    ref,
    replace_children_table,
    source,
    table_name,
    upsert_table,
)

SOURCE = "erp"
OUTSIDE = "outside the load window"
#: Source name of the marks that models keep of their raw tables.
MODEL_MARKS = "models"


def ensure_raw(spark: SparkSession, tenant: str, entity: Entity, root: str | None = None, buckets: int = 16) -> str:
    """The entity's raw table, created if missing. Child tables are keyed by their parent, each child by its own id too."""
    ensure_database(spark, tenant, "raw", root)
    table = table_name(tenant, "raw", entity.name)
    replaced = entity.load == "children" and entity.parent_key
    own = list(entity.keys) if replaced else []
    ensure_table(spark, table, table_columns(entity), [entity.parent_key] if replaced else list(entity.keys), unique=own)
    return table


def ensure_state(spark: SparkSession, tenant: str, root: str | None = None) -> str:
    """The table of watermarks. A mark is a partition of its own: loads that run at once do not touch one another's."""
    ensure_database(spark, tenant, "raw", root)
    table = table_name(tenant, "raw", "etl_watermarks")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({WATERMARK_SCHEMA}) USING parquet "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({', '.join(WATERMARK_KEYS)})"
    )
    return table


def with_generated_ids(items: DataFrame, entity: Entity, now: datetime) -> DataFrame:
    """Ids for records that come without one, the same on every run."""
    kind = entity.options.get("generated_id")
    if kind == "sale_item":
        return fill_uuid5(items, "id", *sale_item_parts("venda_id", "numero_item", "codigo"))
    if kind == "invoice_item":
        return fill_uuid5(items, "id", *invoice_item_parts("chave_acesso", "numero_item"))
    if kind == "opening_balance":
        return fill_uuid5(items, "id", *opening_balance_parts("conta_financeira_id", "data_referencia"))
    if entity.load == "snapshot":  # one row per account and day; a second run on the day overwrites the first
        day = F.coalesce(F.col("snapshot_date"), F.lit(now.date()))
        made = uuid5_key(F.lit(entity.name), "conta_financeira_id", day.cast("string"))
        moment = F.coalesce(F.col("data_snapshot"), instant(now.replace(microsecond=0)))
        return items.withColumns({"id": F.coalesce("id", made), "snapshot_date": day, "data_snapshot": moment})
    return items


def in_scope(entity: Entity, now: datetime, mark: dict | None) -> Column:
    """The rows a run takes: inside the entity's window and, with a cursor, changed since then.

    A row without the date or change time that would decide is taken: a merge of a known row does no harm.
    """
    since = mark["value"] if mark and mark.get("value") else None
    taken: Column = F.lit(True)
    if entity.load == "window":
        taken = rolling_window(entity.date_column, entity.days, now.date())
    elif entity.load == "chunks":
        taken = rolling_window(entity.date_column, entity.options["look_back"], now.date())
    elif entity.load == "changes":
        start, until = window_bounds(now, mark, entity.days)
        taken = F.col(entity.date_column).isNull() | in_window(entity.date_column, start, until)
    if since is not None and entity.load in ("incremental", "window") and entity.watermarked:
        taken = taken & changed_since("data_alteracao", since)
    return F.coalesce(taken, F.lit(True))


def load_entity(
    spark: SparkSession,
    tenant: str,
    name: str,
    items: DataFrame,
    now: datetime,
    run_id: str | None = None,
    root: str | None = None,
    mode: str = "quarantine",
    order: Iterable[str] = ("page", "source_file", "position"),
    buckets: int = 16,
    replay: tuple[str, int] | None = None,
) -> tuple[int, DataFrame]:
    """Merge landed items (JSON text in ``item``) into the raw table and move the watermark.

    ``items`` may also carry ``page`` or ``source_file`` and ``position`` (arrival order within the batch; a place on
    the page alone is no order if pages differ) and, for detail entities,
    the parent's key under the child's column name and ``parent_changed_at``. Returns the row count and the items not
    loaded, each with its ``_problem``: rejected ones and those outside the window that the run takes. ``replay`` names a
    stream and its micro-batch, which is merged once however often it comes.
    """
    entity = ENTITIES[name]
    table = ensure_raw(spark, tenant, entity, root, buckets)
    state = ensure_state(spark, tenant, root)
    mark = get_watermark(read(spark, state), tenant, SOURCE, name) if entity.watermarked else None

    keep = tuple(c for c in items.columns if c != "item")
    rows = parse_entity(items, entity, now, keep=keep)
    if mode == "fail":
        rows = split_valid(rows, mode)[0].withColumn("_problem", F.lit(None).cast("string"))
    if entity.options.get("numbers"):  # without a place on the page only a number of its own counts
        # A name that the text does not hold, plainly or with an escape, is not looked for by parsing the item again.
        may = {n: F.col("raw").contains(n) | F.col("raw").contains("\\") for n in entity.options["numbers"]}
        given = [F.when(held, F.get_json_object("raw", f"$.{n}")) for n, held in may.items()]
        position = F.col("position") if "position" in keep else F.lit(None).cast("int")
        rows = rows.withColumns({f"_n{i}": c for i, c in enumerate(given)})
        rows = rows.withColumn(
            "numero_item", line_number(position, *[f"_n{i}" for i in range(len(given))])
        )
    rows = with_generated_ids(rows, entity, now)

    has_changed = "data_alteracao" in rows.columns
    own = F.col("data_alteracao") if has_changed else F.lit(None).cast("timestamp")
    parent = F.col("parent_changed_at") if "parent_changed_at" in rows.columns else F.lit(None).cast("timestamp")
    seen = parent if entity.options.get("high_water") == "parent" else F.coalesce(own, parent)
    by = [c for c in order if c in rows.columns]
    extra = [c for c in by if c not in table_columns(entity)]
    columns = [c for c in table_columns(entity) if c in rows.columns]
    outside = F.when(~in_scope(entity, now, mark), F.lit(OUTSIDE))
    rows = rows.withColumn("_problem", F.coalesce("_problem", outside))
    taken = F.col("_problem").isNull()
    stored, count, high = write_once(
        rows.select(*columns, *extra, "_problem", taken.alias("_taken"), seen.alias("_seen")), name
    )
    batch = stored.where("_taken").drop("_problem", "_taken")
    rejected = stored.where(F.col("_problem").isNotNull()).drop("_taken")

    if entity.load == "children" and entity.parent_key:
        batch = latest_delivery(batch, entity.parent_key, [c for c in by if c != "position"])
        batch = latest_by_few(batch, list(entity.keys), by)
        replace_children_table(spark, table, batch.drop(*extra), entity.parent_key, replay)
    else:
        upsert_table(spark, table, batch, entity.keys, by, entity.insert_only, now, replay)

    if entity.watermarked:
        value = now.replace(microsecond=0) if entity.load == "changes" and count else high
        row = watermark_row(spark, tenant, SOURCE, name, value, count, run_id, now)
        if row is not None:
            row.select(*spark.table(state).columns).write.insertInto(state, overwrite=True)
    return count, rejected


def latest_delivery(children: DataFrame, parent: str, order: list[str]) -> DataFrame:
    """Of a parent whose list came more than once, the children of the last delivery; they are stored, to be read more than once.

    The parent's hash leads the join, so that sorting seldom compares texts. Children without a parent all stay.
    """
    if not order:
        return children
    spark = children.sparkSession
    delivery = F.col(order[0]) if len(order) == 1 else F.struct(*order)  # a bare number is aggregated without a sort
    keyed = children.withColumn("_hash", F.xxhash64(parent))
    named = keyed.groupBy(F.col("_hash").alias("_of"), F.col(parent).alias("_parent"))
    last = named.agg(F.max(delivery).alias("_last")).where(F.col("_parent").isNotNull())
    same = (F.col("_hash") == F.col("_of")) & (F.col(parent) == F.col("_parent"))
    late = keyed.join(last, same, "left").where(F.col(parent).isNull() | delivery.eqNullSafe(F.col("_last")))
    path = shared_dir(spark, "delivered")
    late.select(*children.columns).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(children.schema).parquet(path)


def table_columns(entity: Entity) -> dict[str, str]:
    single = entity.options.get("singleton")
    return {single: "int", **entity.columns} if single else entity.columns


def write_once(rows: DataFrame, name: str) -> tuple[DataFrame, int, str | None]:
    """Parse a batch once: store it below the shared folder and take count and high water on the way.

    The merge and the list of rejected items read these columns instead of parsing JSON again.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, f"batch-{name}")
    observed, seen = counted(
        rows,
        path,
        F.count_if("_taken").alias("taken"),
        F.max(F.when(F.col("_taken"), F.col("_seen"))).cast("string").alias("high"),
    )
    observed.drop("_seen").write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(rows.drop("_seen").schema).parquet(path)
    high = seen.get["high"]
    return stored, seen.get["taken"], high.replace(" ", "T") if high else None


def build_model(
    spark: SparkSession, tenant: str, model: Model, as_of: datetime, full_refresh: bool = False, buckets: int = 16
) -> int | None:
    """Build and store one model; returns the rows of a fully written table, else None.

    An incremental model reads what was written to its raw tables after the write it saw last; that number is kept as a mark
    beside the loads' marks once the model is stored, so a build that fails is simply repeated.
    """
    table = table_name(tenant, model.layer, model.name)
    frames, marks = [], {}
    partly = model.mode == "incremental" and not full_refresh and spark.catalog.tableExists(table)
    state = ensure_state(spark, tenant) if model.mode == "incremental" else None
    for name in model.inputs:
        if name.startswith("raw:"):
            raw = table_name(tenant, "raw", name[4:])
            if state is None:
                frames.append(read(spark, raw))
                continue
            entity = f"{model.name}<{name[4:]}"
            marks[entity] = last_change(spark, raw)  # before the read: what lands while a build runs is left for the next one
            seen = get_watermark(read(spark, state), tenant, MODEL_MARKS, entity) if partly else None
            frames.append(changed_after(spark, raw, int(seen["value"])) if seen else read(spark, raw))
        else:
            frames.append(ref(spark, table_name(tenant, MODELS[name].layer, name)))
    df = model.build(*frames, as_of) if model.dated else model.build(*frames)
    if model.mode == "view":
        materialize(df, table, "view", drop_first=model.drop_first)
        return None
    if model.mode == "incremental" and full_refresh:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    if model.mode == "incremental":
        materialize(df, table, "incremental", key=model.key)
        for entity, number in marks.items():
            row = watermark_row(spark, tenant, MODEL_MARKS, entity, str(number), 0, None, as_of, "id")
            row.select(*spark.table(state).columns).write.insertInto(state, overwrite=True)
        return None
    observed, seen = counted(df, f"{table}_{uuid.uuid4().hex[:8]}")
    materialize(observed, table, model.mode, drop_first=model.drop_first)
    return seen.get["rows"]


def build_models(
    spark: SparkSession,
    tenant: str,
    names: Iterable[str] | None = None,
    as_of: datetime | None = None,
    full_refresh: bool = False,
    root: str | None = None,
    buckets: int = 16,
) -> dict[str, int | None]:
    """Build models in layer order (staging, curated, delivery)."""
    for layer in ("staging", "curated", "delivery"):
        ensure_database(spark, tenant, layer, root)
    wanted = set(names) if names is not None else set(MODELS)
    moment = as_of or datetime.now()
    return {
        name: build_model(spark, tenant, model, moment, full_refresh, buckets)
        for name, model in MODELS.items()
        if name in wanted
    }


def check_models(spark: SparkSession, tenant: str, names: Iterable[str] | None = None) -> DataFrame:
    """One table of check results over the models."""
    wanted = [m for m in MODELS.values() if m.checks and (names is None or m.name in set(names))]
    return reduce(
        DataFrame.unionByName,
        [run_checks(ref(spark, table_name(tenant, m.layer, m.name)), m.name, m.checks) for m in wanted],
    )


def check_raw(spark: SparkSession, tenant: str, names: Iterable[str]) -> DataFrame:
    """Key and required-column checks of raw tables."""
    parts = []
    for name in names:
        entity = ENTITIES[name]
        checks = [c for key in entity.keys for c in (not_null(key), unique(key))]
        checks += [not_null(f.name) for f in entity.fields if f.required and f.name not in entity.keys]
        checks.append(not_null("loaded_at"))
        if entity.options.get("singleton"):
            checks.append(singleton(entity.options["singleton"]))
        parts.append(run_checks(source(spark, tenant, name), name, checks))
    return reduce(DataFrame.unionByName, parts)

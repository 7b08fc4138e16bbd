"""Jobs of a tenant run that go beyond one plain load: details of changed parents, charges, balances, chunks, streams, whole runs.

Landed details carry ``parent_id``, the key they were asked for. Which of them a run takes is one join with the keys of
the changed parents; nothing loops over parents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.changes import changed_keys, scan_ids
from ledgerlake.operators.runlog import RUN_LOG_KEYS, task_log
from ledgerlake.operators.watermark import get_watermark, watermark_row
from ledgerlake.operators.windows import date_chunks
from ledgerlake.plans import loads
from ledgerlake.sources.entities import ENTITIES, Entity
from ledgerlake.sources.pages import unwrap_pages
from ledgerlake.sources.tables import FEW_ROWS, all_rows, append, ensure_database, ensure_table, read, source, table_name, upsert_table
from ledgerlake.streaming.ingest import run_available, stream_name

#: Loads that skip an unusable record and go on; all others stop at the first one.
SKIPPING = ("parents", "children", "scan", "snapshot")
TASKS = "run_id string, task_id string, map_index int, status string, started_at timestamp, finished_at timestamp, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, error string"


def mode_of(entity: Entity) -> str:
    return "quarantine" if entity.load in SKIPPING else "fail"


def raw_tables(spark: SparkSession, tenant: str, names: Iterable[str]) -> list[DataFrame]:
    """Raw tables that exist by now; before the first run of a parent there is none."""
    return [source(spark, tenant, n) for n in names if spark.catalog.tableExists(table_name(tenant, "raw", n))]


def due_since(spark: SparkSession, tenant: str, entity: Entity) -> str | None:
    """The entity's mark, if it keeps one and has been loaded."""
    if not entity.watermarked:
        return None
    state = loads.ensure_state(spark, tenant)
    return (get_watermark(read(spark, state), tenant, loads.SOURCE, entity.name) or {}).get("value")


def parent_changes(table: DataFrame, entity: Entity, since: str | None) -> DataFrame:
    """``parent_id, parent_changed_at`` and the columns that the child takes over, of a table's rows that changed after the mark."""
    key, taken = entity.options.get("parent_id", "id"), entity.options.get("parent_columns", {})
    time = next((c for c in ("data_alteracao", "data_emissao") if c in table.columns), None)
    seen = F.col(time) if time else F.lit(None).cast("timestamp")
    slim = table.select(F.col(key).alias("parent_id"), seen.alias("parent_changed_at"), *[F.col(c).alias(n) for n, c in taken.items()])
    if since is not None:
        slim = changed_keys(slim.select(F.struct("*").alias("p"), F.col("parent_changed_at")), "p", "parent_changed_at", since).select("p.*")
    return slim


def many_due(spark: SparkSession, tenant: str, entity: Entity) -> bool:
    """Whether more parents may be due than a broadcast should hold: a count over the change times of all their writes, without a join."""
    since = due_since(spark, tenant, entity)
    held = [table_name(tenant, "raw", n) for n in entity.parents if spark.catalog.tableExists(table_name(tenant, "raw", n))]
    return sum(parent_changes(all_rows(spark, t), entity, since).count() for t in held) > FEW_ROWS


def due_parents(spark: SparkSession, tenant: str, entity: Entity) -> DataFrame:
    """``parent_id, parent_changed_at`` and the columns that the child takes over: parents changed after the entity's mark.

    Entities without a mark of their own take all parents. A parent in several tables, or more than once, is one row with its last change.
    """
    taken, since = entity.options.get("parent_columns", {}), due_since(spark, tenant, entity)
    parts = [parent_changes(t, entity, since).where("parent_id is not null") for t in raw_tables(spark, tenant, entity.parents)]
    if not parts:
        empty = "parent_id string, parent_changed_at timestamp" + "".join(f", {n} string" for n in taken)
        return spark.createDataFrame([], empty)
    rows = reduce(DataFrame.unionByName, parts)
    last = F.max(F.struct("parent_changed_at", *taken)).alias("last")
    return rows.groupBy("parent_id").agg(last).select("parent_id", "last.*")


def load_details(spark: SparkSession, tenant: str, name: str, landed: DataFrame, now: datetime, **options) -> tuple[int, DataFrame]:
    """Load the landed details (``item, parent_id``, arrival order) whose parent changed since the entity's mark.

    The mark moves to the child's change time, or to its parent's where the child has none. A record without the
    parent's key, or without an id where the detail is the parent's own, gets it from ``parent_id``. Few parents are broadcast;
    more are sorted with the details, because Spark would take the compressed bytes of either side for its size.
    """
    entity = ENTITIES[name]
    due = due_parents(spark, tenant, entity)
    due = due.hint("merge") if many_due(spark, tenant, entity) else F.broadcast(due)
    named = entity.parent_key or "id"
    items = landed.join(due, "parent_id").withColumn(named, F.col("parent_id")).drop("parent_id")
    return loads.load_entity(spark, tenant, name, items, now, **{"mode": mode_of(entity), **options})


def load_charges(spark: SparkSession, tenant: str, landed: DataFrame, now: datetime, **options) -> tuple[int, DataFrame]:
    """Load the landed charges that the stored records of their parents name at any depth."""
    entity = ENTITIES["cobrancas"]
    parts = [scan_ids(t, "raw") for t in raw_tables(spark, tenant, entity.parents)]
    if not parts:
        return loads.load_entity(spark, tenant, entity.name, landed.limit(0).drop("parent_id"), now, **options)
    ids = reduce(DataFrame.unionByName, parts).distinct().withColumnRenamed("id", "parent_id")
    items = landed.join(ids, "parent_id", "left_semi").withColumnRenamed("parent_id", "id")
    return loads.load_entity(spark, tenant, entity.name, items, now, **{"mode": mode_of(entity), **options})


def load_balances(spark: SparkSession, tenant: str, landed: DataFrame, now: datetime, **options) -> tuple[int, DataFrame]:
    """Load today's balances of active accounts; an account without a flag counts as active, an unknown one does not."""
    entity = ENTITIES["saldo_atual"]
    accounts = source(spark, tenant, entity.parents[0]).where(F.coalesce("ativo", F.lit(True))).select(F.col("id").alias("parent_id"))
    asked = landed if "parent_id" in landed.columns else landed.withColumn("parent_id", F.get_json_object("item", "$.conta_financeira_id"))
    items = asked.join(accounts, "parent_id", "left_semi").withColumnRenamed("parent_id", "conta_financeira_id")
    return loads.load_entity(spark, tenant, entity.name, items, now, **{"mode": mode_of(entity), **options})


def load_chunks(
    spark: SparkSession, tenant: str, name: str, fetch: Callable[[date, date], DataFrame], now: datetime, run_id: str, **options
) -> list[tuple[date, date]]:
    """Load an entity chunk by chunk of its look-back window; a rerun of the same run starts at the first chunk that is open.

    ``fetch`` gives the landed items of a range of days. Each finished chunk is a row of the state table; returns the
    ranges that this call loaded. The list of chunks is a few rows: days of the window over days of a chunk.
    """
    entity = ENTITIES[name]
    state = loads.ensure_state(spark, tenant)
    start = now.date() - timedelta(days=entity.options["look_back"])
    marks = read(spark, state).where((F.col("tenant") == tenant) & (F.col("run_id") == run_id) & F.col("entity").startswith(f"{name}:"))
    done = {r["entity"] for r in marks.select("entity").collect()}
    loaded = []
    for row in date_chunks(spark, start, now.date(), entity.days).orderBy("chunk").collect():
        first, last = row["chunk_start"], row["chunk_end"]
        mark = f"{name}:{first}:{last}"
        if mark in done:
            continue
        count, _ = loads.load_entity(spark, tenant, name, fetch(first, last), now, run_id, **{"mode": mode_of(entity), **options})
        written = watermark_row(spark, tenant, loads.SOURCE, mark, last.isoformat(), count, run_id, now, "cursor")
        written.select(*spark.table(state).columns).write.insertInto(state, overwrite=True)
        loaded.append((first, last))
    return loaded


def ensure_quarantine(spark: SparkSession, tenant: str, name: str) -> str:
    """Records a load could not use, with their reason; a rerun of the same pages replaces its own."""
    ensure_database(spark, tenant, "raw")
    table = table_name(tenant, "raw", f"quarantine_{name}")
    ensure_table(spark, table, {"source_file": "string", "position": "int", "raw": "string", "problem": "string", "loaded_at": "timestamp"}, ["source_file", "position"])
    return table


def stream_pages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed responses as a stream of ``source_file, body``, a file each."""
    text = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_per_batch).load(path)
    return text.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("body"))


def stream_load(
    pages: DataFrame, tenant: str, name: str, checkpoint: str, clock: Callable[[], datetime], shape: str | None = None
) -> StreamingQuery:
    """Load a stream of landed pages: parse, set unusable records aside, merge and move the mark, once per micro-batch.

    All writes go by the stream's name and the micro-batch's number, so a replayed batch changes nothing.
    """
    entity = ENTITIES[name]
    wanted = shape or entity.options.get("shape", "page")
    stream = stream_name("load", f"{tenant}.{name}", checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, clock()
        items = unwrap_pages(batch, wanted, entity.options.get("item_keys", ()))
        _, rejected = loads.load_entity(spark, tenant, name, items, now, order=("source_file", "position"), replay=(stream, batch_id))
        kept = F.col("raw") if "raw" in rejected.columns else F.lit(None).cast("string")
        rows = rejected.select("source_file", "position", kept.alias("raw"), F.col("_problem").alias("problem"), "loaded_at")
        append(spark, ensure_quarantine(spark, tenant, name), rows, "quarantine", (stream, batch_id))

    return run_available(pages, write, checkpoint, stream)


def ensure_run_log(spark: SparkSession, tenant: str) -> str:
    ensure_database(spark, tenant, "raw")
    table = table_name(tenant, "raw", "run_log")
    columns = {f.name: f.dataType.simpleString() for f in task_log(spark.createDataFrame([], TASKS)).schema.fields}
    ensure_table(spark, table, columns, list(RUN_LOG_KEYS))
    return table


def logged(spark: SparkSession, tenant: str, run_id: str, task_id: str, action: Callable[[], int | None], clock: Callable[[], datetime]) -> int | None:
    """Run a task and keep its start, end, rows and error in the run log; an error is kept and raised again."""
    log, started = ensure_run_log(spark, tenant), clock()

    def note(status: str, rows: int | None, error: str | None) -> None:
        row = spark.createDataFrame([(run_id, task_id, -1, status, started, clock(), rows, 0, 0, error)], TASKS)
        upsert_table(spark, log, task_log(row), list(RUN_LOG_KEYS))

    note("running", None, None)
    try:
        rows = action()
    except Exception as error:
        note("failed", None, str(error))
        raise
    note("success", rows, None)
    return rows


def in_order(names: Iterable[str]) -> list[str]:
    """Entities with their parents before them."""
    wanted, out = list(names), []

    def put(name: str) -> None:
        for parent in ENTITIES[name].parents:
            if parent in wanted:
                put(parent)
        if name not in out:
            out.append(name)

    for name in wanted:
        put(name)
    return out


def load_run(
    spark: SparkSession, tenant: str, landed: Mapping[str, DataFrame], now: datetime, run_id: str, clock: Callable[[], datetime] | None = None
) -> dict[str, int]:
    """Load what has landed, parents first, each entity in the way it is declared; every load is a row of the run log."""
    counts: dict[str, int] = {}
    for name in in_order(landed):
        entity, items = ENTITIES[name], landed[name]

        def load(entity: Entity = entity, items: DataFrame = items) -> int:
            if entity.load == "scan":
                return load_charges(spark, tenant, items, now, run_id=run_id)[0]
            if entity.load == "snapshot":
                return load_balances(spark, tenant, items, now, run_id=run_id)[0]
            if entity.parents:
                return load_details(spark, tenant, entity.name, items, now, run_id=run_id)[0]
            return loads.load_entity(spark, tenant, entity.name, items, now, run_id, mode=mode_of(entity))[0]

        counts[name] = logged(spark, tenant, run_id, f"load.{name}", load, clock or (lambda: now))
    return counts

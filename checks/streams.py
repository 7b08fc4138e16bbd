"""Streaming queries over the test tables: the stored result equals the batch answer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.mapping import load
from checks.models import Query, plain
from checks.operations import LINE_COLUMNS, LINE_KEYS, last_line
from ledgerlake.session import shared_dir
from ledgerlake.sources import tables
from ledgerlake.streaming.ingest import stream_children, stream_files, stream_upsert

TENANT = "streams"


def _table(spark: SparkSession, name: str, columns: dict[str, str], key: list[str]) -> tuple[str, str]:
    """A fresh keyed table and the folder for the stream's progress."""
    home = shared_dir(spark, name)
    tables.ensure_database(spark, TENANT, "raw", shared_dir(spark, "db"))
    table = tables.table_name(TENANT, "raw", f"{name}_{home.rsplit('-', 1)[1]}")
    tables.ensure_table(spark, table, columns, key, 8)
    return table, f"{home}/progress"


def q_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines as a stream, upserted by (order, line); the latest ship date of a key stays."""
    shape = load(spark, sf_dir, "lineitem").schema
    columns = {f.name: f.dataType.simpleString() for f in shape.fields}
    table, progress = _table(spark, "lines", {**columns, "loaded_at": "timestamp"}, LINE_KEYS)
    stream = stream_files(spark, f"{sf_dir}/lineitem*.parquet", shape, "parquet")
    stream_upsert(
        stream, table, LINE_KEYS, progress, ["l_shipdate"], clock=lambda: datetime(1998, 6, 1)
    ).awaitTermination()
    return plain(tables.read(spark, table).drop("loaded_at"))


def q_stream_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns replace the stored turns of their conversation; other stored ones stay.

    A conversation lands as one record, the records in several files, and each file is a micro-batch.
    """
    turns = load(spark, sf_dir, "conversations")
    columns = {f.name: f.dataType.simpleString() for f in turns.schema.fields}
    table, progress = _table(spark, "turns", columns, ["conv_id"])
    stored = load(spark, sf_dir, "conversations").select(
        (F.col("conv_id") + F.when(F.col("turn") % 2 == 0, 0).otherwise(1000000)).alias("conv_id"),
        (F.col("turn") + 100).alias("turn"),
        "role",
        F.lit("old").alias("text"),
    )
    tables.replace_children_table(spark, table, stored, "conv_id")
    landed = shared_dir(spark, "conversations")
    rest = F.struct(*[c for c in turns.columns if c != "conv_id"])
    records = turns.groupBy("conv_id").agg(F.collect_list(rest).alias("turns"))
    records.repartition(3).write.parquet(landed)
    stream = stream_files(spark, landed, records.schema, "parquet", files_per_batch=1)
    stream_children(
        stream, table, "conv_id", progress, lambda rows: rows.select("conv_id", F.inline("turns")).select(*columns)
    ).awaitTermination()
    return tables.read(spark, table)


QUERIES: dict[str, Query] = {"stream_upsert": q_stream_upsert, "stream_children": q_stream_children}
ORACLE: dict[str, str] = {
    "stream_upsert": f"with {last_line('true', 'kept')} select {LINE_COLUMNS} from kept",
    "stream_children": """select conv_id, turn, role, text from conversations
union all select conv_id + 1000000, turn + 100, role, 'old' from conversations where turn % 2 = 1""",
}

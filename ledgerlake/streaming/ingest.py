"""Landed files as a stream: exactly-once progress, keyed and idempotent writes.

Progress lives in the query's checkpoint (shared storage); every micro-batch is merged with the same
idempotent merge the batch jobs use, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators.upsert import latest_by
from ledgerlake.sources.tables import replace_children_table, upsert_table


def stream_files(
    spark: SparkSession, path: str, schema: str, fmt: str = "json", files_per_batch: int = 1000
) -> DataFrame:
    """New files below a path, each read once."""
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)
    )


def run_available(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, name: str
) -> StreamingQuery:
    """Process everything that has landed so far, in micro-batches, then stop."""
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def stream_name(kind: str, table: str, checkpoint: str) -> str:
    """A name of the stream's own: another checkpoint is another stream, whose micro-batches are numbered anew."""
    return f"{kind}_{table.replace('.', '_')}_{zlib.crc32(checkpoint.encode()):08x}"


def stream_upsert(
    stream: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    order: Sequence[str | Column] = (),
    insert_only: Sequence[str] = (),
    clock: Callable[[], datetime] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Upsert a stream into a keyed table; ``order`` decides between rows of one key in one batch.

    Each micro-batch is one write under the stream's name and the batch's number, so a replayed one appends nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stamp = clock() if clock else None
        upsert_table(batch.sparkSession, table, batch, keys, order, insert_only, stamp, replay=(name, batch_id))

    name = name or stream_name("upsert", table, checkpoint)
    return run_available(stream, write, checkpoint, name)


def stream_children(
    stream: DataFrame,
    table: str,
    parent: str,
    checkpoint: str,
    unfold: Callable[[DataFrame], DataFrame],
    order: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Replace the children of every parent that a micro-batch brings.

    The stream has one record per delivery of a parent, with its children in it; ``unfold`` makes child rows of these
    records inside the micro-batch. A record is never cut, so the result does not depend on how files fall into
    batches. Of a parent that comes more than once in a batch the last record in ``order`` counts, and without one the
    greatest.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = unfold(latest_by(batch, [parent], order))
        replace_children_table(rows.sparkSession, table, rows, parent, replay=(name, batch_id))

    name = name or stream_name("children", table, checkpoint)
    return run_available(stream, write, checkpoint, name)

"""A global row number that does not pass through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir


def global_row_number(
    df: DataFrame, order: Sequence[str | Column], name: str = "seq", partitions: int | None = None
) -> DataFrame:
    """Number all rows 1…n in ``order``; give an order without ties for repeatable numbers.

    Rows are range-partitioned and sorted per partition; the sorted parts are written once below the
    shared checkpoint folder, so that a lost executor cannot move a range border between the two reads.
    A second pass counts rows per part (one row per part) and adds the parts before it.
    """
    spark = df.sparkSession
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    path = shared_dir(spark, "row-number")
    (
        ranged.sortWithinPartitions(*columns)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .write.parquet(path)
    )
    parts = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per written part, however many rows there are: safe to broadcast.
    return parts.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos") + 1).alias(name), *df.columns
    )

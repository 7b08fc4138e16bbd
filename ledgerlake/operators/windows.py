"""Calendar windows: rolling look-back and chunked date ranges."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.time import instant


def rolling_window(column: str, days: int, as_of: date) -> Column:
    """Within the last ``days`` days up to and including ``as_of``; later dates are out."""
    day = F.col(column).cast("date")
    return day.between(F.lit(as_of - timedelta(days=days)), F.lit(as_of))


def changed_since(column: str, since: datetime | str | None) -> Column:
    """Changed at or after the cursor; everything on the first run."""
    return F.lit(True) if since is None else F.col(column) >= instant(since)


def date_chunks(
    spark: SparkSession, start: date, end: date, days: int, inclusive_end: bool = True
) -> DataFrame:
    """Consecutive ranges of ``days + 1`` calendar days (both ends count), cut off at ``end``.

    With ``inclusive_end=False`` a chunk that would consist of the last day alone is left out.
    """
    last = end if inclusive_end else end - timedelta(days=1)
    starts = F.sequence(F.lit(start), F.lit(last), F.expr(f"interval {days + 1} days"))
    if start > last:
        return spark.createDataFrame([], "chunk int, chunk_start date, chunk_end date")
    return spark.range(1).select(F.posexplode(starts).alias("chunk", "chunk_start")).select(
        "chunk",
        "chunk_start",
        F.least(F.date_add("chunk_start", days), F.lit(end)).alias("chunk_end"),
    )


def chunk_of(column: str, start: date, days: int) -> Column:
    """Number of the chunk a date falls in: arithmetic instead of a range join."""
    return F.floor(F.datediff(F.col(column).cast("date"), F.lit(start)) / (days + 1)).cast("int")


def count_by_chunk(df: DataFrame, column: str, chunks: DataFrame, start: date, days: int) -> DataFrame:
    """Rows per chunk, empty chunks included.

    Rows are counted per chunk number first (map-side partial), so the join only sees one row per chunk.
    """
    counted = df.groupBy(chunk_of(column, start, days).alias("chunk")).agg(F.count(F.lit(1)).alias("n"))
    return chunks.join(counted, "chunk", "left").withColumn("n", F.coalesce("n", F.lit(0)))

"""High-water marks: per (tenant, source, entity) cursors kept in a small keyed table."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.time import instant

WATERMARK_KEYS = ("tenant", "source", "entity")
WATERMARK_SCHEMA = (
    "tenant string, source string, entity string, watermark string, rows_loaded bigint, run_id string, "
    "updated_at timestamp"
)
KINDS = ("timestamp", "id", "cursor", "compound")


def get_watermark(state: DataFrame, tenant: str, source: str, entity: str) -> dict | None:
    """The stored cursor, or None on the first run."""
    row = (
        state.where(
            (F.col("tenant") == tenant) & (F.col("source") == source) & (F.col("entity") == entity)
        )
        .select("watermark")
        .first()
    )
    return json.loads(row[0]) if row and row[0] else None


def watermark_row(
    spark: SparkSession,
    tenant: str,
    source: str,
    entity: str,
    value: object,
    rows_loaded: int,
    run_id: str | None,
    now: datetime,
    kind: str = "timestamp",
) -> DataFrame | None:
    """The state row to upsert, or None when the batch showed no value (the old cursor stays)."""
    if value is None:
        return None
    if kind not in KINDS:
        raise ValueError(f"unknown watermark kind {kind!r}")
    text = value.isoformat() if isinstance(value, datetime) else value
    mark = json.dumps({"type": kind, "value": text})
    return spark.createDataFrame(
        [(tenant, source, entity, mark, rows_loaded, run_id, now)], WATERMARK_SCHEMA
    )


def high_water(df: DataFrame, column: str, fallback: str | None = None) -> DataFrame:
    """One row with the greatest non-NULL value; ``fallback`` (a parent's column) fills gaps."""
    value: Column = F.coalesce(column, fallback) if fallback else F.col(column)
    return df.agg(F.max(value).alias("high_water"))


def window_bounds(now: datetime, mark: dict | None, default_days: int = 30) -> tuple[datetime, datetime]:
    """A read window whose end is fixed before reading: from the cursor, or ``default_days`` back."""
    until = now.replace(microsecond=0)
    if mark and mark.get("value"):
        since = datetime.fromisoformat(mark["value"].replace("Z", "+00:00")).replace(microsecond=0, tzinfo=None)
    else:
        since = until - timedelta(days=default_days)
    return since, until


def in_window(column: str, since: datetime, until: datetime) -> Column:
    return F.col(column).between(instant(since), instant(until))


def incremental_slice(
    source: DataFrame,
    target: DataFrame | None,
    loaded: str = "loaded_at",
    cursor: str = "staged_at",
) -> DataFrame:
    """Source rows loaded after the target's newest ``cursor``; everything when there is no target.

    The bound is read as one scalar and becomes a literal, so it prunes partitions and row groups.
    ``cursor="raw_loaded_at"`` compares load time with load time and cannot miss a row that was
    committed while the target was being built.
    """
    if target is None:
        return source
    bound = target.agg(F.max(cursor).cast("string")).first()[0] or "1900-01-01 00:00:00"
    return source.where(F.col(loaded) > F.lit(bound).cast(source.schema[loaded].dataType))

"""Keyed merges of a batch into a table, as plain DataFrame joins.

Every merge is "keep the target rows the batch does not replace, then add the batch". The keep step is
a left-anti join against the batch's distinct keys (combined map-side, so a very frequent key is one
row). Spark turns it into a broadcast join when the measured size of these keys is below its broadcast
limit, so that the target is not shuffled, and into a sort-merge join beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import assert_key
from ledgerlake.functions.time import instant
from ledgerlake.session import shared_dir

_UNORDERED = (T.MapType, T.VariantType)


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], tie_break: bool = True
) -> DataFrame:
    """The last row per key: greatest ``order`` wins, then the greatest of all other columns.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a key that
    holds a third of the batch still sends a row per task only.
    """
    given = [F.col(o) if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)} | set(keys)
    ties = [
        F.col(f.name)
        for f in df.schema.fields
        if tie_break and f.name not in named and not isinstance(f.dataType, _UNORDERED)
    ]
    window = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in given + ties])
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


#: Repeated keys up to which their rows are taken out of a batch by a broadcast; beyond, the whole batch is ranked.
FEW_REPEATED = 400_000


def latest_by_few(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], few: int = FEW_REPEATED) -> DataFrame:
    """``latest_by`` for a batch that can be read again: only rows whose key occurs more than once are ranked.

    A pass over 64-bit hashes of the keys finds those that repeat; all other rows are neither shuffled nor sorted. Two keys
    that share a hash are ranked by their own values, so the rows are those of ``latest_by``. A batch whose rows can differ
    between two readings must be stored first.
    """
    if any("collate" in df.schema[k].dataType.simpleString() for k in keys):
        return latest_by(df, keys, order)  # equal keys of such a type need not have equal hashes
    hashed = F.xxhash64(*keys)
    twice = df.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_hash")
    path = shared_dir(df.sparkSession, "repeated-keys")
    twice.write.parquet(path)
    repeated = df.sparkSession.read.schema("_hash long").parquet(path)
    found = repeated.count()
    if not found:
        return df
    if found > few:
        return latest_by(df, keys, order)
    same = hashed == F.col("_hash")
    ranked = latest_by(df.join(F.broadcast(repeated), same, "left_semi"), keys, order)
    return df.join(F.broadcast(repeated), same, "left_anti").unionByName(ranked)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (),
    insert_only: Sequence[str] = (),
    loaded_at: datetime | Column | None = None,
) -> DataFrame:
    """Insert new keys and overwrite known ones; the last row of a key in the batch counts.

    Without an order, or between rows equal in it, the greatest values of the other columns count, so a key never
    gets two rows.

    ``insert_only`` columns of a known key keep the target's value, NULL included. ``loaded_at`` stamps
    every row the batch touched. A NULL key in the batch raises.
    """
    keys = list(keys)
    rows = latest_by(batch, keys, order)
    rows = rows.withColumns({k: assert_key(k, k) for k in keys})
    if loaded_at is not None:
        stamp = loaded_at if isinstance(loaded_at, Column) else instant(loaded_at)
        rows = rows.withColumn("loaded_at", stamp)
    named = batch.select(*keys).distinct()
    kept = target.join(named, keys, "left_anti")
    if insert_only:
        old = target.join(named, keys, "left_semi").select(
            *keys, F.struct(*insert_only).alias("_old")
        )
        rows = rows.join(old, keys, "left").withColumns(
            {
                c: F.when(F.col("_old").isNotNull(), F.col("_old")[c]).otherwise(F.col(c))
                for c in insert_only
            }
        )
    return kept.unionByName(rows.select(*target.columns))


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace every target row whose key occurs in the batch; columns new to the batch are added."""
    keys = list(keys)
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return align_append(kept, batch)


def replace_children(target: DataFrame, batch: DataFrame, parent: Sequence[str] | str) -> DataFrame:
    """Replace all children of the parents in the batch; parents without children there stay as they are.

    A child without a parent raises.
    """
    on = [parent] if isinstance(parent, str) else list(parent)
    batch = batch.withColumns({p: assert_key(p, p) for p in on})
    kept = target.join(batch.select(*on).distinct(), on, "left_anti")
    return align_append(kept, batch)


def align_append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; a column only one side has is NULL on the other."""
    return target.unionByName(batch, allowMissingColumns=True)

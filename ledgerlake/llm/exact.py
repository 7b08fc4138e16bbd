"""Exact dedup through an extendible-hash index in shared files; column expressions only.

Texts are equal when they agree byte for byte after each run of white space became one space. A 64-bit key of that
text addresses a directory of ``2**deepest`` slots by its leading bits. The directory starts with one slot and
doubles as long as a bucket holds more bytes than ``capacity``; slots that share a bucket stay together. A finest slot
that is still too full doubles its own part of the directory further, by the next bits of the key, until each of its
buckets fits or holds a single key. A bucket is a range of keys.

Each row brings its text to the task that owns the text's bucket; copies within a task collapse before that, so a text
that a third of all rows share arrives as one row per task. The owner chains the texts of a key and compares their
bytes: two texts that share a key are two entries. The entries are the index, written by bucket; every row finds its group
there by bucket, key and digest.

A null text equals an empty one; a null id sorts before all others; rows that repeat both id and text of the row that
stays are all marked as kept. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACE, stored

#: Bytes of distinct text a bucket may hold before it splits; bits of the slots that the driver knows one by one (2**12), and
#: bits by which one of them can double further.
CAPACITY = 16 << 20
DEEPEST = 12
FURTHER = 50


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def directory(sizes: dict[int, int], capacity: int = CAPACITY, deepest: int = DEEPEST) -> list[int]:
    """Bucket of each of the ``2**deepest`` finest slots; ``sizes`` has the bytes by finest slot.

    Doubling the directory splits every bucket that is too full at the next leading bit of the key.
    """
    spans, full = [], [(0, 0)]
    while full:
        again = []
        for prefix, depth in full:
            width = deepest - depth
            held = sum(sizes.get(k, 0) for k in range(prefix << width, (prefix + 1) << width))
            if held > capacity and depth < deepest:
                again += [(prefix << 1, depth + 1), (prefix << 1 | 1, depth + 1)]
            else:
                spans.append((prefix << width, (prefix + 1) << width))
        full = again
    slots = [0] * (1 << deepest)
    for bucket, (low, high) in enumerate(sorted(spans)):
        slots[low:high] = [bucket] * (high - low)
    return slots


def _sql(values: list[int]) -> str:
    """The value of a row's finest slot."""
    return f"element_at(array({','.join(map(str, values))}), slot + 1)"


def _by_slot(values: list[int]) -> Column:
    return F.expr(_sql(values))


def _further(bits: list[int], deepest: int) -> Column:
    """The bits of the key behind its slot: as many as the slot's own doublings."""
    return F.when(_by_slot(bits) > 0, F.expr(f"shiftrightunsigned(shiftleft(key, {deepest}), 64 - {_sql(bits)})")).otherwise(F.lit(0).cast("long"))


def doublings(once: DataFrame, sizes: dict[int, int], capacity: int = CAPACITY, deepest: int = DEEPEST) -> list[int]:
    """Further bits of each finest slot; ``once`` has ``slot, key, n_bytes`` of the distinct keys.

    Each round reads the sizes of the buckets of the slots that are still too full: one row per slot on the driver.
    """
    bits = [0] * (1 << deepest)
    worst = {slot: held for slot, held in sizes.items() if held > capacity}
    while worst:
        for slot, held in worst.items():
            bits[slot] = min(FURTHER, bits[slot] + max(1, math.ceil(math.log2(held / capacity))))
        again = [slot for slot in worst if bits[slot] < FURTHER]
        if not again:
            break
        buckets = (
            once.where(_by_slot([int(k in worst) for k in range(1 << deepest)]) == 1)
            .groupBy("slot", _further(bits, deepest).alias("sub"))
            .agg(F.sum("n_bytes").alias("held"), (F.min("key") != F.max("key")).alias("several"))
        )
        full = buckets.where(F.col("several") & (F.col("held") > capacity)).groupBy("slot").agg(F.max("held").alias("held"))
        worst = {r["slot"]: r["held"] for r in full.collect() if r["slot"] in again}
    return bits


def build_index(docs: DataFrame, capacity: int = CAPACITY, deepest: int = DEEPEST) -> tuple[DataFrame, DataFrame]:
    """The stored keys of all rows with their buckets, and the stored index: one entry per distinct text, by bucket."""
    key = F.xxhash64("norm")
    slot = F.shiftrightunsigned("key", 64 - deepest).cast("int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    sha = F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256")
    keys = stored(texts.select("doc_id", key.alias("key"), F.octet_length("norm").cast("long").alias("n_bytes"), sha), "exact-keys")
    once = keys.groupBy("key", "n_bytes").agg(F.lit(1).alias("one")).withColumn("slot", slot)
    sizes = {r[0]: r[1] for r in once.groupBy("slot").agg(F.sum("n_bytes")).collect()}
    slots, bits = directory(sizes, capacity, deepest), doublings(once, sizes, capacity, deepest)
    bucket = F.shiftleft(_by_slot(slots).cast("long"), FURTHER).bitwiseOR(_further(bits, deepest)).alias("bucket")
    collapsed = (
        texts.select("doc_id", "norm", key.alias("key"), F.spark_partition_id().alias("task"))
        .groupBy("task", "key", "norm")
        .agg(F.min(F.struct("doc_id")).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    owned = collapsed.withColumn("slot", slot).select("key", "norm", "first", "n", bucket).repartition("bucket")
    entries = (
        owned.groupBy("bucket", "key", "norm")  # no further shuffle: the owner has all texts of its buckets
        .agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
        .select("bucket", "key", sha, F.col("first.doc_id").alias("keep_id"), "group_size")
        .sortWithinPartitions("bucket", "key")
    )
    return keys.withColumn("slot", slot).select("doc_id", "key", "text_sha256", bucket), stored(entries, "exact-index")


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, deepest: int = DEEPEST) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    A key with many rows is no hot task: both sides of the join are plain shuffles, which adaptive execution splits.
    """
    keys, index = build_index(docs, capacity, deepest)
    return (
        keys.join(index, ["bucket", "key", "text_sha256"])
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def first_of_groups(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns: one that ``exact_groups`` keeps, and of rows that repeat its
    id and text the least in the other columns.

    Rows are found again by id and text, so an id on two different texts does no harm.
    """
    sha, has, own, at = "text_sha256", "has_id_", "id_", "place_"
    while {sha, has, own, at} & set(docs.columns):
        sha, has, own, at = (f"{name}_" for name in (sha, has, own, at))
    # The rows that stay of a text share its id, so the rows of one id and text are the group to number: what the join has
    # shuffled by is not shuffled again.
    number = F.col("doc_id").cast("long")
    marked = docs.withColumns({
        sha: F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256), has: number.isNotNull(), own: F.coalesce(number, F.lit(0).cast("long")),
    })
    staying = exact_groups(docs).where("kept").select(
        F.col("text_sha256").alias(sha), F.col("doc_id").isNotNull().alias(has), F.coalesce("doc_id", F.lit(0).cast("long")).alias(own)
    ).distinct()
    kept = marked.join(staying, [sha, has, own], "left_semi")
    ordered = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    least = Window.partitionBy(sha, has, own).orderBy(*ordered)
    return kept.withColumn(at, F.row_number().over(least)).where(F.col(at) == 1).select(docs.columns)

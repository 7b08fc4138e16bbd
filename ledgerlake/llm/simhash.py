"""SimHash near-dedup by a self-join of binary tries.

Every whole text becomes a 64-bit fingerprint of its word shingles. Equal fingerprints collapse first, so a group of
copies is one fingerprint. Two fingerprints at ``budget`` or fewer differing bits agree on at least one of
``budget + 1`` blocks of bits; fingerprints with an equal block are the leaves of one trie. A task joins its tries
with themselves: node pairs are walked together, level by level, a pair's differing bits add up, and a pair is
dropped once it exceeds the budget. A pair of nodes whose leaves are all linked already is dropped as well: it can
add no link to a class. Groups then are connected components, found by contracting links in Spark.

An overfull block group is dealt out: its rows fall into chunks and each pair of chunks is a trie of its own, so no
task holds more than two chunks. The table of group sizes has at most ``(budget + 1) * 2**13`` rows.

A text without words has fingerprint zero and links like any other; null texts are empty; rows that repeat an id
share its fingerprint's class; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import stored, whole_texts

BITS, SEED = 64, 42
#: Fingerprints of a block group that one chunk holds, and node pairs that a task walks at once.
CHUNK, FRONT = 4096, 1 << 18


def fingerprint(text: str, shingle: int = 4) -> int:
    """Bits set in over half of the XXH64 hashes of the text's word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, white space of the word rule
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest, count, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), 0
    while block := [digest(line[a:b], SEED) for (a, b), _ in zip(spans, range(65_536), strict=False)]:
        bits = np.unpackbits(np.array(block, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
        if len(block) < 65_536:
            break
    return int.from_bytes(np.packbits(count * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, key: str = "doc_id") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=[key, "fp"])

    return whole_texts(docs, key).mapInArrow(run, f"{key} long, fp long")


def _blocks(budget: int) -> list[tuple[int, int]]:
    """Shift and width of each of the ``budget + 1`` blocks of bits."""
    edges = np.linspace(0, BITS, budget + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges, edges[1:], strict=False)]


class Classes:
    """Union-find with the smallest member as root."""

    def __init__(self, size: int):
        self.up = np.arange(size)

    def roots(self) -> np.ndarray:
        while True:
            above = self.up[self.up]
            if np.array_equal(above, self.up):
                return self.up
            self.up = above

    def link(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Join the pairs; true where a pair joined two classes when its turn came."""
        up, joined = self.roots().tolist(), np.zeros(len(a), bool)
        fresh = np.flatnonzero(self.up[a] != self.up[b])
        for k in fresh.tolist():
            x, y = int(a[k]), int(b[k])
            while up[x] != x:
                up[x] = x = up[up[x]]
            while up[y] != y:
                up[y] = y = up[up[y]]
            if x != y:
                up[max(x, y)] = min(x, y)
                joined[k] = True
        self.up = np.array(up)
        return joined


def trie_links(fps: np.ndarray, roots: np.ndarray, budget: int, front: int = FRONT) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each trie, all leaves at ``budget`` or fewer differing bits.

    ``fps``: unsigned fingerprints, sorted and distinct within each trie; ``roots``: first leaf of each trie. A node
    is a range of leaves that share their leading bits. Returns the indices of the linked leaves.
    """
    n = len(fps)
    ends = np.append(roots[1:], n)
    classes, found = Classes(n), [(np.zeros(0, int),) * 2]
    one, top = np.uint64(1), BITS - 1
    stack = [(0, roots, ends, roots, ends, np.zeros(len(roots), np.int8))]
    while stack:
        level, a, a_end, b, b_end, err = stack.pop()
        if len(a) > front:
            for k in range(0, len(a), front):
                stack.append((level, *(x[k : k + front] for x in (a, a_end, b, b_end, err))))
            continue
        up = classes.roots()
        run = np.append(np.flatnonzero(np.diff(up)) + 1, n)
        same = run[np.searchsorted(run, np.arange(n), "right")] if n < front else None
        if same is not None:
            live = ~((up[a] == up[b]) & (same[a] >= a_end) & (same[b] >= b_end))
            a, a_end, b, b_end, err = (x[live] for x in (a, a_end, b, b_end, err))
        # small node pairs end here: their leaves are compared at once
        small = (a_end - a) * (b_end - b) <= 16 if level < BITS else np.ones(len(a), bool)
        if small.any():
            x, y = _leaf_pairs(*(v[small] for v in (a, a_end, b, b_end)))
            close = np.bitwise_count(fps[x] ^ fps[y]) <= budget
            x, y = x[close], y[close]
            fresh = classes.link(x, y)
            found.append((x[fresh], y[fresh]))
            a, a_end, b, b_end, err = (v[~small] for v in (a, a_end, b, b_end, err))
        if not len(a):
            continue
        bit = np.uint64(top - level)
        ones = np.concatenate([[0], np.cumsum((fps >> bit) & one).astype(np.int64)])
        a_mid, b_mid = a_end - (ones[a_end] - ones[a]), b_end - (ones[b_end] - ones[b])
        self_pair = a == b
        nxt = []
        for p, p_end, q, q_end, more, keep in (
            (a, a_mid, b, b_mid, 0, True),
            (a_mid, a_end, b_mid, b_end, 0, True),
            (a, a_mid, b_mid, b_end, 1, True),
            (a_mid, a_end, b, b_mid, 1, ~self_pair),
        ):
            ok = (p < p_end) & (q < q_end) & (err + more <= budget) & keep
            ok &= ~((p == q) & (p_end - p == 1))
            nxt.append(tuple(v[ok] for v in (p, p_end, q, q_end, err + np.int8(more))))
        far = tuple(np.concatenate(v) for v in zip(*nxt[2:], strict=True))
        near = tuple(np.concatenate(v) for v in zip(*nxt[:2], strict=True))
        stack += [(level + 1, *x) for x in (far, near) if len(x[0])]
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def _leaf_pairs(a, a_end, b, b_end) -> tuple[np.ndarray, np.ndarray]:
    """All leaf pairs of the node pairs; of a node with itself each pair once."""
    wide = b_end - b
    sizes = (a_end - a) * wide
    row = np.repeat(np.arange(len(a)), sizes)
    at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    x, y = a[row] + at // wide[row], b[row] + at % wide[row]
    keep = x < y
    return x[keep], y[keep]


def links(prints: DataFrame, budget: int = 4, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that connect all at ``budget`` or fewer bits."""
    blocks = _blocks(budget)
    value = lambda shift, width: F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1)
    keys = F.array(*[(value(s, w) + F.lit(k << 16)).cast("int") for k, (s, w) in enumerate(blocks)])
    leaves = prints.select("fp", F.explode(keys).alias("block"))
    sizes = leaves.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")  # (budget + 1) * 2**13 rows at most
    chunks = F.ceil(F.col("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    dealt = (
        leaves.join(F.broadcast(sizes), "block")
        .select("fp", "block", own.alias("own"), other.alias("other"))
        .select("fp", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    tries = dealt.repartition("block", "low", "high").sortWithinPartitions("block", "low", "high", F.expr("fp ^ (1L << 63)"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []
        held = 0

        def joined(rows: np.ndarray) -> pa.RecordBatch:
            fps = rows[0].view(np.uint64)
            roots = np.flatnonzero(np.append(True, (rows[1:, 1:] != rows[1:, :-1]).any(axis=0)))
            x, y = trie_links(fps, roots, budget)
            return pa.RecordBatch.from_arrays([pa.array(rows[0][x]), pa.array(rows[0][y])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rest.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            held += batch.num_rows
            if held >= 8 * chunk:  # the last trie may go on in the next batch
                rows = np.concatenate(rest, axis=1)
                cut = np.flatnonzero((rows[1:, 1:] != rows[1:, :-1]).any(axis=0))
                if len(cut):
                    yield joined(rows[:, : cut[-1] + 1])
                    rows = rows[:, cut[-1] + 1 :]
                rest, held = [rows], rows.shape[1]
        if held:
            yield joined(np.concatenate(rest, axis=1))

    return tries.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: each linked node with the smallest node (as signed longs) of its connected component.

    Alternates two steps until nothing changes: each node points its larger neighbours, then its smaller ones, to its
    smallest neighbour. Each step is one aggregation with partial minima; links are written between the steps.
    """
    pairs = stored(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u <> v").distinct(), "links")
    last = None
    while True:  # each round lowers pointers, so there is a last one
        both = pairs.union(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = stored(both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m")), "large-star")
        large = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        pairs = stored(large.where("u <> v").distinct(), "links")
        low = stored(pairs.groupBy("v").agg(F.min("u").alias("m")), "small-star")
        down = pairs.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(low.select("v", F.col("m").alias("u")))
        pairs = stored(down.where("u <> v").distinct(), "links")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
        pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def _classes(prints: DataFrame, budget: int, key: str) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint; ``root`` is the class's least fingerprint."""
    classes = stored(prints.groupBy("fp").agg(F.min(key).alias("first")), "classes")
    roots = components(links(classes, budget))
    named = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    smallest = stored(named.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    return stored(named.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id"), "names")


def near_groups(docs: DataFrame, shingle: int = 4, budget: int = 4, key: str = "doc_id") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; the component's name is its smallest id."""
    prints = stored(fingerprints(docs, shingle, key), "fingerprints")
    names = _classes(prints, budget, key)
    return prints.join(names, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, shingle: int = 4, budget: int = 4, key: str = "doc_id") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id (a missing id is smaller than all; then by text).

    Rows are told apart by their class, never by their id, so an id on two different texts does no harm.
    """
    columns, mark = docs.columns, "fp"
    place = columns.index("text")
    while mark in columns or f"{mark}root" in columns:
        mark += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t or "", shingle) for t in batch.column(place).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.int64())], names=[*columns, mark])

    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.LongType())])
    marked = stored(docs.mapInArrow(run, schema), "fingerprinted")
    names = _classes(marked.select(F.col(key).cast("long").alias(key), F.col(mark).alias("fp")), budget, key)
    both = marked.join(names.select(F.col("fp").alias(mark), F.struct("root").alias(f"{mark}root")), mark)
    first = Window.partitionBy(f"{mark}root").orderBy(F.col(key).asc_nulls_first(), "text")
    return both.withColumn(mark, F.row_number().over(first)).where(F.col(mark) == 1).select(columns)

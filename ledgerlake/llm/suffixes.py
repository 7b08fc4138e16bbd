"""Removal of repeated passages by longest previous factors.

A byte goes when a string of ``length`` bytes that covers it also starts earlier in the corpus (smaller id, or same
document and earlier start). That is a longest-previous-factor array cut at ``length``: in suffix order, an entry
whose previous or next smaller position shares the first ``length`` bytes has an earlier match. Entries that share them
are neighbours in suffix order; with ties by position the previous entry is the previous smaller position, and the
first entry of a run is the copy that stays.

Sorting every suffix of a corpus would shuffle many times its size, so suffixes are sorted by classes first:

1. Every string of ``length`` bytes has an anchor, its leftmost ``ANCHOR``-gram of least hash, which depends on the
   string alone. Neighbouring strings with one anchor form a span, about one for each 30 bytes. Spans are sorted by
   anchor and content. A span equal to an earlier one repeats with all its strings.
2. Only where an anchor has spans of different content (edges of repeated passages) the strings themselves are
   sorted, by 128-bit hashes.

Hot passages: before a shuffle each batch keeps the earliest of equal spans or strings and passes the others on as
found. Anchors with very many different surroundings are found in a sample, which steers the partitioning only; their
spans are dealt out by content and all count as edges, which is exact as well.

Null texts are empty; strings never cross documents; texts of any length are read in blocks. A missing id sorts first.
Where ids repeat (missing ones too), each row gets a number of its own in the order of id and text hash, and all work
goes by that number: a row loses only its own ranges, and of equal rows all but one lose what they share. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored
from ledgerlake.operators.ranking import global_row_number

LENGTH, ANCHOR = 100, 40
#: Bytes hashed at once. Share of rows in which hot anchors are looked for, contexts that make one hot, most of them.
BLOCK, HOT_SHARE, HOT_CONTEXTS, HOT_MOST = 1 << 20, 0.02, 32, 1000
MISSING = -(1 << 63)
U = np.uint64


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (in place)."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= h >> U(33)
        h *= U(factor)
    h ^= h >> U(33)
    return h


@lru_cache(maxsize=2)
def _family(which: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random byte values, and powers of an odd base and of its inverse modulo 2**64."""
    rng = np.random.default_rng(20_240 + which)
    letters = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
    base = int(rng.integers(1 << 60, 1 << 62)) * 4 + 3
    powers = []
    for b in (base % (1 << 64), pow(base, -1, 1 << 64)):
        row = np.full(size + 1, b, np.uint64)
        row[0] = 1
        powers.append(np.multiply.accumulate(row))
    return letters, *powers


class Hashes:
    """Polynomial hashes of all substrings of some bytes, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int):
        letters, powers, self.back = _family(which, BLOCK + 4 * LENGTH)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * powers[: len(data)], out=self.sums[1:])

    def of(self, starts, ends) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])

    def each(self, size: int) -> np.ndarray:
        """Of every substring of one size."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.back[:n])


def blocks(rows: Iterator[tuple[int, bytes]], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to blocks: bytes, and per part its id, its offset in the text and its end in the block.

    A text longer than a block comes in parts that overlap by ``length - 1`` bytes, so each string is in one part.
    """
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined():
        ends = np.cumsum([len(t) for _, _, t in held])
        ids, offsets = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
        return np.frombuffer(b"".join(t for _, _, t in held), np.uint8), ids, offsets, ends

    for doc, text in rows:
        for start in range(0, max(1, len(text) - length + 1), BLOCK):
            part = text[start : start + BLOCK + length - 1]
            if len(part) < length:
                continue
            if held and size + len(part) > BLOCK + length - 1:
                yield joined()
                held, size = [], 0
            held.append((doc, start, part))
            size += len(part)
    if held:
        yield joined()


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least hash among each ``width`` neighbours."""
    least, place, size = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.where(right, least[step:], least[:-step])
        size += step
    return place


def _earliest(keys: tuple[np.ndarray, ...], ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """True for entries with an earlier entry of the same key: by sorting, the key's first entry is the earliest."""
    order = np.lexsort((starts, ids, *keys[::-1]))
    fresh = np.append(True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0))[: len(order)]
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    later = np.zeros(len(order), bool)
    later[order] = (ids[order] != ids[order][first]) | (starts[order] != starts[order][first])
    return later


def spans(rows: Iterator[tuple[int, bytes]], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchor hash, content hash, id, first start, strings, found`` of all spans, a block at a time."""
    for data, ids, offsets, ends in blocks(rows, length):
        if len(data) < length:
            continue
        first, second = Hashes(data, 0), Hashes(data, 1)
        grams = first.each(gram)
        place = anchors(grams, length - gram + 1)
        part = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        starts = np.flatnonzero(np.arange(len(data)) + length <= ends[part])
        at = place[starts]
        new = np.append(True, (at[1:] != at[:-1]) | (part[starts[1:]] != part[starts[:-1]]))
        low, edges = starts[new], np.flatnonzero(new)
        high = starts[np.append(edges[1:], len(starts)) - 1]
        content = second.of(low, high + length)
        content = mixed(content + (at[new] - low).astype(np.uint64) * U(1 << 32) + (high - low).astype(np.uint64))
        kind, where = grams[at[new]], low - np.append(0, ends[:-1])[part[low]] + offsets[part[low]]
        yield kind, content, ids[part[low]], where, high - low + 1, _earliest((kind, content), ids[part[low]], where)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    return zip(batch.column(0).to_pylist(), (t.as_buffer().to_pybytes() for t in batch.column(1)), strict=True)


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns], names=names)


def _span_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["kind", "content", "id_", "start", "strings", "found"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for made in spans(_texts(batch), length, gram):
                yield _batch(names, *made)

    return docs.select("id_", F.encode("text_", "UTF-8").alias("b")).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of sorted rows, cut so that rows with equal first ``keys`` columns are together."""
    rest: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        rest = own if rest is None else [np.concatenate(x) for x in zip(rest, own, strict=True)]
        cut = np.flatnonzero(np.any([c[1:] != c[:-1] for c in rest[:keys]], axis=0))
        if len(cut):
            yield [c[: cut[-1] + 1] for c in rest]
            rest = [c[cut[-1] + 1 :] for c in rest]
    if rest is not None:
        yield rest


def _first_in_run(keys: list[np.ndarray], ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """In sorted rows: true where no earlier position has the same keys."""
    fresh = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))[: len(ids)]
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
    return (ids == ids[first]) & (starts == starts[first])


def _span_classes(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``id_, start, strings, edge``: spans that repeat (edge 0), and spans whose strings must be sorted (edge 1)."""
    rows = _span_rows(docs, length, gram)
    some = _span_rows(docs.where(F.pmod(F.xxhash64("id_", F.lit("hot")), F.lit(10_000)) < int(HOT_SHARE * 10_000)), length, gram)
    contexts = some.where("found = 0").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT_CONTEXTS)
    hot = sorted(r[0] for r in contexts.orderBy(F.desc("n"), "kind").limit(HOT_MOST).collect())
    is_hot = F.col("kind").isin(hot) if hot else F.lit(False)
    # rows already found need no company, so they are dealt out by document
    salt = F.when(F.col("found") == 1, F.xxhash64("id_", "start")).when(is_hot, F.col("content")).otherwise(F.lit(0).cast("long"))
    kind = F.when(F.col("found") == 1, F.lit(0).cast("long")).otherwise(F.col("kind"))
    content = F.when(F.col("found") == 1, F.lit(0).cast("long")).otherwise(F.col("content"))  # not looked at again, and small in the shuffle
    dealt = rows.select(kind.alias("kind"), salt.alias("salt"), content.alias("content"), "id_", "start", (F.col("strings") * 2 + F.col("found")).alias("size"))
    dealt = dealt.repartition("kind", "salt").drop("salt").sortWithinPartitions("kind", "content", "id_", "start")
    names, heavy = ["id_", "start", "strings", "edge"], np.array(hot, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, content, ids, start, size in _runs(batches, 1):
            found, strings = (size & 1).astype(bool), size >> 1
            yield _batch(names, ids[found], start[found], strings[found], np.zeros(found.sum(), np.int64))
            kind, content, ids, start, strings = (c[~found] for c in (kind, content, ids, start, strings))
            if not len(kind):
                continue
            first = _first_in_run([kind, content], ids, start)
            other = np.append(False, (content[1:] != content[:-1]) & (kind[1:] == kind[:-1]))
            run_of = np.cumsum(np.append(True, kind[1:] != kind[:-1])) - 1
            mixed_kind = np.bincount(run_of, weights=other)[run_of] > 0
            edge = first & (mixed_kind | np.isin(kind, heavy))
            keep = edge | ~first
            yield _batch(names, ids[keep], start[keep], strings[keep], edge[keep])

    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _string_rows(docs: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """``first, second, id_, start, found`` of the strings in edge spans."""
    lists = edges.groupBy("id_").agg(F.sort_array(F.collect_list(F.struct("start", "strings"))).alias("spans"))
    both = compressed(docs).join(lists, "id_").select("id_", "b", F.col("spans.start").alias("s"), F.col("spans.strings").alias("n"))
    names = ["first", "second", "id_", "start", "found"]

    def strings(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        wanted = [(i, zstandard.decompress(b.as_buffer()), np.array(s.as_py(), np.int64), np.array(n.as_py(), np.int64)) for i, b, s, n in zip(batch.column(0).to_pylist(), *batch.columns[1:], strict=True)]
        for data, ids, offsets, ends in blocks(((k, w[1]) for k, w in enumerate(wanted)), length):
            begin = np.append(0, ends[:-1])
            places, owner = [], []
            for part, (k, offset) in enumerate(zip(ids, offsets, strict=True)):
                s, n = wanted[k][2:]
                at = np.repeat(s - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                at = at[(at >= offset) & (at - offset + length <= ends[part] - begin[part])] - offset
                places.append(at + begin[part])
                owner.append(np.full(len(at), part))
            at, part = np.concatenate(places), np.concatenate(owner)
            if not len(at):
                continue
            first, second = (Hashes(data, k).of(at, at + length) for k in (0, 1))
            doc = np.array([wanted[k][0] for k in ids], np.int64)[part]
            start = at - begin[part] + offsets[part]
            yield first, second, doc, start, _earliest((first, second), doc, start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for made in strings(batch):
                yield _batch(names, *made)

    return both.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _repeated_strings(rows: DataFrame) -> DataFrame:
    """``id_, start, strings`` of the strings with an earlier match, neighbours joined."""
    # rows already found need no company: they are dealt out by place, and their hashes are not looked at again
    known, place = F.col("found") == 1, F.xxhash64("id_", F.shiftright("start", 16))
    slim = rows.withColumns({"first": F.when(known, place).otherwise(F.col("first")), "second": F.when(known, F.lit(0).cast("long")).otherwise(F.col("second"))})
    dealt = slim.repartition("first").sortWithinPartitions("first", "second", "id_", "start")
    names = ["id_", "start", "strings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, second, ids, start, found in _runs(batches, 2):
            found, fresh = found.astype(bool), found == 0
            later = found.copy()
            if fresh.any():
                later[fresh] = ~_first_in_run([first[fresh], second[fresh]], ids[fresh], start[fresh])
            ids, start = ids[later], start[later]
            order = np.lexsort((start, ids))
            ids, start = ids[order], start[order]
            new = np.append(True, (ids[1:] != ids[:-1]) | (start[1:] > start[:-1] + 1))[: len(ids)]
            low = np.flatnonzero(new)
            high = np.append(low[1:], len(ids)) - 1
            yield _batch(names, ids[low], start[low], start[high] - start[low] + 1) if len(low) else _batch(names, *[np.zeros(0, np.int64)] * 3)

    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def by_document(docs: DataFrame) -> DataFrame:
    """``id_, doc_, text_``: a number that no other row has, in the order of the ids, the id itself and the whole text.

    Unique ids are their own numbers, and the texts are read where they are. Only where ids repeat rows are numbered, and then
    stored once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_"), F.coalesce(F.col("text"), F.lit("")).alias("text_"))
    own = F.coalesce("doc_", F.lit(MISSING))
    if rows.groupBy(own.alias("id_")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return rows.select(own.alias("id_"), "doc_", "text_")
    placed = rows.select("doc_", "text_", F.xxhash64("text_").alias("hash_"), F.monotonically_increasing_id().alias("row_"))
    return stored(global_row_number(placed, ["doc_", "hash_", "row_"], "id_").select("id_", "doc_", "text_"), "texts")


def compressed(docs: DataFrame) -> DataFrame:
    """``id_, doc_, b``: the text's bytes compressed, as they go through a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = pa.array([pack.compress(t.as_buffer()) for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], names=["id_", "doc_", "b"])

    return docs.select("id_", "doc_", F.encode("text_", "UTF-8").alias("b")).mapInArrow(run, "id_ long, doc_ long, b binary")


def remove_ranges(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside the ranges, how many went, and in how many maximal runs."""
    starts, ends = np.minimum(starts, len(text)), np.minimum(ends, len(text))
    order = np.argsort(starts, kind="stable")
    kept, at, gone, runs = [], 0, 0, 0
    last = -1
    for a, b in zip(starts[order].tolist(), ends[order].tolist(), strict=True):
        if a >= b:
            continue
        if a > last:
            runs += 1
            kept.append(text[at:a])
            gone += b - a
            last = at = b
        elif b > last:
            gone += b - last
            last = at = b
    return b"".join([*kept, text[at:]]), gone, runs


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = ANCHOR) -> DataFrame:
    """``id_, start, strings``: runs of starts whose string has an earlier match. ``docs``: see ``by_document``."""
    classes = stored(_span_classes(docs, length, gram), "spans")
    strings = stored(_repeated_strings(_string_rows(docs, classes.where("edge = 1"), length)), "strings")
    return classes.where("edge = 0").drop("edge").union(strings)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = ANCHOR, with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, and the kept bytes on demand."""
    texts = by_document(docs)
    ranges = repeated_ranges(texts, length, gram)
    lists = ranges.groupBy("id_").agg(F.collect_list(F.struct("start", "strings")).alias("ranges"))
    both = compressed(texts).join(lists, "id_", "left").select("doc_", "b", F.col("ranges.start").alias("s"), F.col("ranges.strings").alias("n"))
    fields = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for i, b, s, n in zip(*batch.columns, strict=True):
                text, starts = zstandard.decompress(b.as_buffer()), np.array(s.as_py() or [], np.int64)
                kept, gone, runs = remove_ranges(text, starts, starts + np.array(n.as_py() or [], np.int64) + length - 1)
                for column, x in zip(out, (i.as_py(), len(text), gone, runs, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    column.append(x)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            many = 5 + with_text
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out[:many], kinds[:many], strict=True)], names=names[:many])

    return both.mapInArrow(run, fields)

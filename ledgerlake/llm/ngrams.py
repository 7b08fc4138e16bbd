"""Counting n-grams of whole corpora: shards of word numbers, and sorted counters that are merged by slice of the key space.

A shard is one row: some million tokens as numbers of the shard's own word list. What a shard asks for travels as
one blob per slice, sorted and compressed; whoever owns the slice merges the blobs of all shards and may answer each of
them. So a very frequent word or n-gram is one entry per shard, a slice holds a bounded part of all entries, and no
dictionary is broadcast. The number of slices follows the number of tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ends a document or a piece of text; the byte is in no UTF-8 text.
END = b"\xff"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Tokens of a shard; tokens of the corpus that a slice stands for; least number of slices, as a power of two.
SHARD_TOKENS, SLICE_TOKENS, LEAST_BITS = 2_000_000, 4_000_000, 6

SHARD_SCHEMA = "shard long, grp string, kind int, docs array<long>, sizes array<int>, n_tokens long, n_words long, tokens binary, words binary"


def squeeze(values: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes, compressed: small numbers, or small steps, take little room."""
    values = np.ascontiguousarray(values, dtype="<u8")
    used = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    return bytes([used]) + zstandard.compress(values.view(np.uint8).reshape(-1, 8).T[:used].tobytes(), 1)


def widen(blob: bytes, n: int) -> np.ndarray:
    used, out = blob[0], np.zeros((n, 8), np.uint8)
    if used:
        out[:, :used] = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8).reshape(used, n).T
    return out.view("<u8").ravel()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(k) for k in range(len(names))]
        for k in range(batch.num_rows):
            yield {name: column[k].as_py() for name, column in zip(names, columns, strict=True)}


def batches_of(rows: Iterable[dict], schema: pa.Schema, size: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``size`` bytes."""
    held, room = [], 0
    for row in rows:
        held.append(row)
        room += 64 + sum(len(v) for v in row.values() if isinstance(v, (bytes, list)))
        if room >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, room = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


class _Shard:
    def __init__(self, grp: str, kind: int):
        self.grp, self.kind = grp, kind
        self.ids: dict[bytes, int] = {END: 0}
        self.tokens: list[int] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []

    def add(self, doc: int | None, words: list[bytes]) -> None:
        ids = self.ids
        put = ids.setdefault
        self.tokens += [put(w, len(ids)) for w in words]
        self.docs.append(doc)
        self.sizes.append(len(words))

    def row(self, number: int) -> dict:
        tokens = np.array(self.tokens, dtype=np.uint64)
        return {
            "shard": number, "grp": self.grp, "kind": self.kind, "docs": self.docs, "sizes": self.sizes, "n_tokens": len(tokens),
            "n_words": len(self.ids), "tokens": squeeze(tokens), "words": zstandard.compress(b"\n".join(self.ids), 3),
        }


def shard_texts(texts: DataFrame, split: Callable[[bytes], list[bytes]], shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Shards of ``grp, kind, doc_id, text``: each holds documents of one group and kind, and whole documents only.

    ``split`` makes the tokens of a text; number 0 of a shard's word list is ``END``.
    """
    schema = pa.schema([
        ("shard", pa.int64()), ("grp", pa.string()), ("kind", pa.int32()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
        ("n_tokens", pa.int64()), ("n_words", pa.int64()), ("tokens", pa.binary()), ("words", pa.binary()),
    ])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 32
        open_: dict[tuple, _Shard] = {}
        held = 0
        for batch in batches:
            for grp, kind, doc, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                at = open_.setdefault((grp, kind), _Shard(grp, kind))
                words = split(text)
                at.add(doc, words)
                held += len(words)
                full = [(grp, kind)] if len(at.tokens) >= shard_tokens else list(open_) if held >= 2 * shard_tokens else []
                for key in full:
                    done = open_.pop(key)
                    held -= len(done.tokens)
                    yield done.row(number)
                    number += 1
        for done in open_.values():
            yield done.row(number)
            number += 1

    columns = texts.select("grp", "kind", "doc_id", F.col("text").cast("binary").alias("text"))
    return columns.mapInArrow(lambda batches: batches_of(shards(batches), schema), SHARD_SCHEMA)


def slice_bits(tokens: int) -> int:
    return max(LEAST_BITS, (max(tokens, 1) // SLICE_TOKENS).bit_length())


# words: merged by their text


def words_of(row: dict) -> list[bytes]:
    return zstandard.decompress(row["words"]).split(b"\n")


def word_requests(row: dict, tokens: np.ndarray, words: list[bytes], bits: int) -> Iterator[dict]:
    """A shard's words with their counts and numbers, one row per slice."""
    counts = np.bincount(tokens.astype(np.int64), minlength=len(words))
    slices = np.fromiter((zlib.crc32(w) & ((1 << bits) - 1) for w in words), np.int64, len(words))
    order = np.argsort(slices, kind="stable")
    ends = np.searchsorted(slices[order], np.arange((1 << bits) + 1))
    for k in range(1 << bits):
        if at := order[ends[k] : ends[k + 1]].tolist():
            yield {
                "level": 1, "grp": row["grp"], "slice": k, "shard": row["shard"], "kind": row["kind"], "n": len(at),
                "keys": zstandard.compress(b"\n".join([words[i] for i in at]), 1), "extra": squeeze(np.diff(np.array(at), prepend=0)),
                "counts": squeeze(counts[at]),
            }


def asked_words(rows: list[dict]) -> tuple[dict[bytes, int], list[np.ndarray]]:
    """The distinct words of a slice, and for each row the places of its words among them."""
    index: dict[bytes, int] = {}
    put = index.setdefault
    places = [np.array([put(w, len(index)) for w in zstandard.decompress(r["keys"]).split(b"\n")]) for r in rows]
    return index, places


# n-grams: merged by key


def distinct(left: np.ndarray, right: np.ndarray | None = None, counts: np.ndarray | None = None):
    """Sorted distinct keys and their summed counts (1 each, if none are given)."""
    if right is None and counts is None:
        left, counts = np.sort(left), np.ones(len(left), np.int64)
    else:
        order = np.argsort(left, kind="stable") if right is None else np.lexsort((right, left))
        left, right = left[order], None if right is None else right[order]
        counts = np.ones(len(left), np.int64) if counts is None else counts[order]
    new = np.ones(len(left), bool)
    new[1:] = left[1:] != left[:-1]
    if right is not None:
        new[1:] |= right[1:] != right[:-1]
    starts = np.flatnonzero(new)
    return left[starts], None if right is None else right[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def key_requests(left: np.ndarray, right: np.ndarray | None, counts: np.ndarray, width: int, bits: int, base: dict) -> Iterator[dict]:
    """Sorted keys of ``width`` bits as one row per slice (quotient): remainders in small steps, and counts."""
    low = np.uint64(width - bits)
    ends = np.searchsorted(left >> low, np.arange((1 << bits) + 1, dtype=np.uint64))
    remainder = left & np.uint64((1 << (width - bits)) - 1)
    for k in range(1 << bits):
        a, b = int(ends[k]), int(ends[k + 1])
        if a < b:
            yield {
                **base, "slice": k, "n": b - a, "keys": squeeze(np.diff(remainder[a:b], prepend=np.uint64(0))),
                "extra": None if right is None else squeeze(right[a:b]), "counts": squeeze(counts[a:b]),
            }


def keys_of(row: dict, width: int, bits: int) -> tuple[np.ndarray, np.ndarray | None]:
    left = np.cumsum(widen(row["keys"], row["n"]), dtype=np.uint64) | np.uint64(row["slice"] << (width - bits))
    return left, None if row["extra"] is None else widen(row["extra"], row["n"])


REQUEST_SCHEMA = "level int, grp string, slice int, shard long, kind int, n int, keys binary, extra binary, counts binary"
REQUEST_ARROW = pa.schema([
    ("level", pa.int32()), ("grp", pa.string()), ("slice", pa.int32()), ("shard", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()),
    ("keys", pa.binary()), ("extra", pa.binary()), ("counts", pa.binary()),
])


def by_slice(requests: DataFrame) -> DataFrame:
    """Requests of one slice behind one another in one task."""
    keys = ["grp", "level", "slice"]
    return requests.repartition(*keys).sortWithinPartitions(*keys)


def slices_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    return groupby(rows_of(batches), key=lambda r: (r["grp"], r["level"], r["slice"]))

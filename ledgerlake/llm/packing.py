"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed length.

Documents become pieces of at most ``size`` tokens; only longer ones are cut, and only their first piece may be
shorter. Pieces go longest first into the open sequence with the least room that still fits, found in a segment tree
over remaining room. All that best fit needs to know of a piece is its length, so the plan is made from the counts per
length (``size`` numbers, whatever the corpus): sequences with the same content are one entry with a multiplicity.
Spark then ranks the pieces within their length, by partial counts per length and part, and every piece finds its
place in the plan by its rank. Nothing else passes through the driver.

Null and empty texts are a piece with the end token alone; rows that repeat an id are packed once each; an empty table
gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored, whole_texts

SIZE, END = 1024, 2
#: Fixed value: how byte-level BPE splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    """Byte-level BPE of a ``tokenizers`` file: ids of one text, special tokens found in it included.

    The file is read by ``tokenizers``. If it is plain byte-level BPE (``plain``), its ranks are given to the ``tiktoken``
    engine, which makes the same ids in a quarter of the time; tests compare the two. Texts which that engine refuses, such
    as a million blanks in a row, and files of any other kind are encoded by ``tokenizers``.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    whole = Tokenizer.from_file(path)
    slow = lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
    spec = json.loads(whole.to_str())
    if not plain(spec):
        return slow
    to_byte = _byte_letters(ByteLevel.alphabet())
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(map(to_byte.__getitem__, k)): v for k, v in spec["model"]["vocab"].items() if k not in special}
    engine = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        try:
            return engine.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except ValueError:  # its pattern matcher ran out of stack
            return slow(text)

    return encode


def plain(spec: dict) -> bool:
    """Whether a file is byte-level BPE and nothing else, merges ranked by the ids they make, special tokens taken as they stand."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    made = [model["vocab"].get(a + b, -1) for a, b in merges] if model["type"] == "BPE" else []
    return (
        len(made) > 0
        and min(made) >= 0
        and all(a < b for a, b in zip(made, made[1:], strict=False))
        and spec["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
    )


def _byte_letters(alphabet: list[str]) -> dict[str, int]:
    """Letters that stand for bytes: printable Latin-1 is itself, the other bytes follow from U+0100 on, in order."""
    plain = [b for b in range(256) if chr(b) in set(alphabet)]
    rest = [b for b in range(256) if chr(b) not in set(alphabet)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def cuts(tokens: int, size: int = SIZE) -> list[tuple[int, int]]:
    """Start and length of each piece of a document."""
    first = tokens % size or min(tokens, size)
    return [(0, first)] + [(s, size) for s in range(first, tokens, size)]


def pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, key: str = "doc_id") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece; ``tokenizer`` is the file's path on each executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py()), np.array([END], "<u4"))
                for k, (start, length) in enumerate(cuts(len(ids), size)):
                    for column, x in zip(out, (doc_id, k, start, length, zlib.crc32(ids[start : start + length].tobytes())), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    names = [key, "piece", "start", "length", "ids_crc32"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return whole_texts(docs, key).mapInArrow(run, f"{key} long, piece int, start long, length long, ids_crc32 long")


class Tightest:
    """Segment tree over remaining room: the least room of at least ``need`` that some open sequence has."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)

    def add(self, room: int, count: int) -> None:
        node = self.leaves + room
        while node:
            self.tree[node] += count
            node >>= 1

    def find(self, need: int) -> int | None:
        node = self.leaves + need
        if self.tree[node]:
            return need
        while node > 1:  # up until a right neighbour holds something, then down its left edge
            if not node & 1 and self.tree[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit decreasing over ``{length: pieces}``: ``(sequences, [(length, pieces in each)])`` entries.

    Placing a piece leaves its sequence the tightest for equal pieces that follow, so a sequence takes as many of
    them as fit before the next one is opened; whole sets of like sequences are filled at once.
    """
    room_tree = Tightest(size)
    open_sets: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(room: int, many: int, content: list[tuple[int, int]]) -> None:
        open_sets.setdefault(room, []).append((many, content))
        room_tree.add(room, many)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = room_tree.find(length)
            if room is None:
                fit, many, content = size // length, None, []
                room = size
            else:
                many, content = open_sets[room].pop()
                room_tree.add(room, -many)
                fit = room // length
            full = left // fit if many is None else min(many, left // fit)
            if full:
                put(room - fit * length, full, [*content, (length, fit)])
                left -= full * fit
            elif left:
                put(room - left * length, 1, [*content, (length, left)])
                full, left = 1, 0
            if many is not None and many > full:
                put(room, many - full, content)
    return [entry for sets in open_sets.values() for entry in sets]


def places(entries: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, pieces per sequence, offset``, sorted by length and rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for many, content in entries:
        offset = 0
        for length, each in content:
            rows.append((length, taken.get(length, 0), sequence, each, offset))
            taken[length] = taken.get(length, 0) + many * each
            offset += length * each
        sequence += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(rows: DataFrame, size: int = SIZE, key: str = "doc_id", parts: int = 1024) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. ``rows`` should be stored: they are read twice."""
    part = F.pmod(F.xxhash64(key, "piece"), F.lit(parts)).cast("int")
    dealt = rows.withColumn("part_", part)
    counts = stored(dealt.groupBy("length", "part_").agg(F.count(F.lit(1)).alias("n_")), "piece-counts")
    before = counts.select(
        "length", "part_", (F.sum("n_").over(Window.partitionBy("length").orderBy("part_")) - F.col("n_")).alias("before_")
    )
    total = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n_")).collect()}  # at most ``size`` rows
    where = places(plan(total, size))
    ranked = dealt.withColumn(
        "rank_", F.row_number().over(Window.partitionBy("length", "part_").orderBy(key, "piece", "ids_crc32"))
    ).join(before, ["length", "part_"])
    ranked = ranked.select(*rows.columns, (F.col("rank_") + F.col("before_") - 1).alias("rank_"))

    names = [*rows.columns, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = where[:, 0] * (1 << 44) + where[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank_"))
            at = where[np.searchsorted(firsts, length * (1 << 44) + rank, "right") - 1]
            inside = rank - at[:, 1]
            sequence, offset = at[:, 2] + inside // at[:, 3], at[:, 4] + inside % at[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=names
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, key: str = "doc_id") -> DataFrame:
    return pack(stored(pieces(docs, tokenizer, size, key), "pieces"), size, key)

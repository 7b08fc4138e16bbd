"""SentencePiece encoding and decoding with the ``tokenizers`` library as engine.

The model file is a protobuf message; the few fields that matter are read here: pieces with scores and types, the kind
of model, byte fallback and the normaliser's settings. From them a ``tokenizers`` model is rebuilt: a unigram lattice
from the scores, or merges ordered by the score of what they make; spaces become the metaspace mark, and letters
without a piece fall back to bytes. Whole texts are encoded in batches by the library's threads.

No piece has a mark after another letter, so a text may be cut before each run of marks without changing its ids.
Units met before are looked up; the new ones of a batch go to the library together. (If a model has such pieces, or pieces defined by
the user, whole texts go to the library.) With ``verify`` each unit that is met for the first time is also encoded by the
original library, all units of a batch as one text, and a text has parity if none of its units differs; where texts
are not cut into units, whole texts are compared. ``parity`` compares whole texts, ids and decoded text.

Null and empty texts have no ids and decode to an empty text. Texts are encoded whole; repeated rows get equal ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import ChainMap
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import whole_texts

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
#: Units whose ids a worker remembers.
REMEMBERED = 300_000
THREADS = 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            value: object = varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            value = data[at : at + size]
            at += size
        yield tag >> 3, value


def parse_model(data: bytes) -> dict:
    """Pieces as ``(text, score, type)``, kind, byte fallback, unknown id and the normaliser's settings."""
    model = {"pieces": [], "kind": UNIGRAM, "byte_fallback": False, "unknown": 0, "charsmap": b"", "dummy_prefix": True, "squeeze": True, "escape": True}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            model["pieces"].append((piece[1].decode(), struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
        elif number == 2:
            own = dict(_fields(value))
            model |= {"kind": own.get(3, UNIGRAM), "byte_fallback": bool(own.get(35, 0)), "unknown": own.get(40, 0)}
        elif number == 3:
            own = dict(_fields(value))
            model |= {"charsmap": own.get(2, b""), "dummy_prefix": bool(own.get(3, 1)), "squeeze": bool(own.get(4, 1)), "escape": bool(own.get(5, 1))}
    return model


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score of the result first."""
    ids = {p: k for k, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER, UNUSED)}
    found = []
    for whole, k in ids.items():
        for cut in range(1, len(whole)):
            left, right = whole[:cut], whole[cut:]
            if left in ids and right in ids:
                found.append((-pieces[k][1], k, ids[left], ids[right], left, right))
    return [x[-2:] for x in sorted(found)]


class Codec:
    """Ids of texts and texts of ids for one model file."""

    def __init__(self, path: str, threads: int = THREADS, verify: bool = False):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        from tokenizers import Tokenizer, models, normalizers

        with open(path, "rb") as file:
            self.spec = spec = parse_model(file.read())
        pieces = spec["pieces"]
        if spec["kind"] == BPE:
            model = models.BPE(vocab={p: k for k, (p, _, _) in enumerate(pieces)}, merges=merges(pieces), unk_token=pieces[spec["unknown"]][0], fuse_unk=True, byte_fallback=spec["byte_fallback"])
        elif spec["kind"] == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in pieces], unk_id=spec["unknown"], byte_fallback=spec["byte_fallback"])
        else:
            raise ValueError(f"model type {spec['kind']} is neither unigram nor BPE")
        self.engine = Tokenizer(model)
        self.charsmap = normalizers.Precompiled(spec["charsmap"]) if spec["charsmap"] else None
        self.units = not any(MARK in p.lstrip(MARK) for p, _, _ in pieces) and not any(t == USER for _, _, t in pieces)
        self.known: dict[str, bytes] = {}
        self.bytes = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.replace(MARK, " ").encode() for p, _, t in pieces]
        self.user = [p for p, _, t in pieces if t == USER]
        if self.user:
            self.engine.add_tokens(self.user)
        self.original, self.wrong = None, set()
        if verify:
            from sentencepiece import SentencePieceProcessor

            self.original = SentencePieceProcessor(model_file=path)
        # what the engine sees of a unit is then what the original library makes of its plain text
        self.by_unit = self.units and spec["escape"] and spec["dummy_prefix"] and not spec["charsmap"]

    def verified(self, texts: list[str], made: list[np.ndarray]) -> list[bool]:
        """Whether the original library gives the texts the same ids; ``made`` are those that ``encode_batch`` gave."""
        if not self.by_unit:
            return [m.tolist() == w for m, w in zip(made, self.original.encode(texts, num_threads=1), strict=True)]
        if not self.wrong:
            return [True] * len(texts)
        return [self.wrong.isdisjoint(UNITS.findall(self.normalise(t))) for t in texts]

    def _compare(self, fresh: dict[str, bytes]) -> None:
        """Remember the units to which the original library gives other ids."""
        plain = [u for u in fresh if u[-1] != MARK]
        joined = "".join(plain)[1:].replace(MARK, " ")  # it puts the first mark in front itself
        if np.array(self.original.encode(joined), "<u4").tobytes() != b"".join(fresh[u] for u in plain):
            for u in plain:
                if np.array(self.original.encode(u[1:].replace(MARK, " ")), "<u4").tobytes() != fresh[u]:
                    self.wrong.add(u)
        if len(plain) < len(fresh):
            before = np.array(self.original.encode("a"), "<u4").tobytes()
            for u in fresh.keys() - set(plain):  # marks alone end a text
                if np.array(self.original.encode("a" + " " * len(u)), "<u4").tobytes() != before + fresh[u]:
                    self.wrong.add(u)

    def normalise(self, text: str) -> str:
        """The text as the engine sees it: mark for space, one in front of a text that is not empty."""
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        text = text.replace(" ", MARK) if self.spec["escape"] else text
        if self.spec["squeeze"]:
            text = re.sub(f"{MARK}{{2,}}", MARK, text).strip(MARK)
        return MARK + text if text and self.spec["dummy_prefix"] else text

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        lines = [self.normalise(t) for t in texts]
        if not self.units:
            return [np.array(e.ids, "<u4") for e in self.engine.encode_batch(lines, add_special_tokens=False)]
        cut = [UNITS.findall(line) for line in lines]
        known = self.known
        new = list({u for units in cut for u in units if u not in known})
        if new:
            found = self.engine.encode(new, is_pretokenized=True, add_special_tokens=False)
            ids, ends = np.array(found.ids, "<u4"), np.searchsorted(found.word_ids, np.arange(len(new)), "right").tolist()
            fresh = {u: ids[a:b].tobytes() for u, a, b in zip(new, [0, *ends], ends, strict=False)}
            if self.original and self.by_unit:
                self._compare(fresh)
            if len(known) < REMEMBERED:  # frequent units come early
                known.update(fresh)
            else:
                known = ChainMap(fresh, known)
        return [np.frombuffer(b"".join(map(known.__getitem__, units)), "<u4") for units in cut]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; the mark that encoding put in front is taken off."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.spec["dummy_prefix"] and text.startswith(" ") else text


UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@lru_cache(maxsize=2)
def codec(path: str, verify: bool = False) -> Codec:
    return Codec(path, verify=verify)


def encode(docs: DataFrame, path: str, key: str = "doc_id", batch: int = 64) -> DataFrame:
    """``doc_id, ids`` of every row; ``path`` is the model file's place on each executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                made = own.encode_batch(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([m.astype(np.int32) for m in made], pa.list_(pa.int32()))], names=[key, "ids"])

    return whole_texts(docs, key).mapInArrow(run, f"{key} long, ids array<int>")


def decode(rows: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``doc_id, text`` of rows ``doc_id, ids``; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for part in batches:
            texts = [own.decode(i.as_py() or []) for i in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return rows.select(key, "ids").mapInArrow(run, f"{key} long, text string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", batch: int = 64, verify: bool = False) -> DataFrame:
    """Number and checksum of each row's ids, and whether they decode to the text they came from; with ``verify`` also
    whether the original library agrees on the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, verify)
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                texts = part.column(1).to_pylist()
                made = own.encode_batch(texts)
                same = [own.decode(ids.tolist()) == text for ids, text in zip(made, texts, strict=True)]
                columns = [part.column(0), pa.array([len(m) for m in made], pa.int64()), pa.array([zlib.crc32(m.tobytes()) for m in made], pa.int64()), pa.array(same)]
                names = [key, "n_ids", "ids_crc32", "round_trip"]
                if verify:
                    columns, names = [*columns, pa.array(own.verified(texts, made))], [*names, "parity"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    agrees = ", parity boolean" if verify else ""
    return whole_texts(docs, key).mapInArrow(run, f"{key} long, n_ids long, ids_crc32 long, round_trip boolean{agrees}")


def parity(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Rows on which this backend and the original library differ in ids or decoded text; none is as it should be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        own, original = codec(path), SentencePieceProcessor(model_file=path)
        for rows in batches:
            texts = rows.column(1).to_pylist()
            made, wanted = own.encode_batch(texts), original.encode(texts, num_threads=1)
            differs = [m.tolist() != w or own.decode(w) != original.decode(w) for m, w in zip(made, wanted, strict=True)]
            yield rows.filter(pa.array(differs)).select([0])

    return whole_texts(docs, key).mapInArrow(run, f"{key} long")

"""Parity with the original library inside the query, and a unigram model that the test writes itself."""

from __future__ import annotations

import random
import struct

import pytest
from sentencepiece import SentencePieceProcessor

from ledgerlake.llm import pieces, queries
from ledgerlake.llm.pieces import BPE, BYTE, CONTROL, MARK, NORMAL, UNIGRAM, UNKNOWN


def varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def number(field: int, n: int) -> bytes:
    return varint(field << 3) + varint(n)


def nested(field: int, data: bytes) -> bytes:
    return varint(field << 3 | 2) + varint(len(data)) + data


def model_file(kind: int, squeeze: bool) -> bytes:
    """A small model: control pieces, all bytes, letters, and some longer pieces with scores of their own."""
    rng = random.Random(7)
    found = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), ("</s>", 0.0, CONTROL)]
    found += [(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)]
    longer = ["ab", "abc", "bc", "cab", "bca", MARK + "a", MARK + "ab", MARK + "abc", MARK + "b", MARK + MARK, "de", "ed", MARK + "de"]
    found += [(p, -1.0 - k - rng.random() / 2, NORMAL) for k, p in enumerate(longer)]
    found += [(c, -20.0 - k - rng.random() / 2, NORMAL) for k, c in enumerate(MARK + "abcdeé")]
    body = b"".join(nested(1, nested(1, p.encode()) + b"\x15" + struct.pack("<f", s) + number(3, t)) for p, s, t in found)
    body += nested(2, number(3, kind) + number(4, len(found)) + number(35, 1))
    return body + nested(3, nested(1, b"identity") + number(3, 1) + number(4, int(squeeze)) + number(5, 1))


def texts(n: int) -> list[str]:
    rng = random.Random(3)
    made = ["".join(rng.choice("aabbccde é x日") for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return ["", " ", "a ", "  a", "a   ", "日本", *made]


@pytest.mark.parametrize("squeeze", [False, True])
@pytest.mark.parametrize("kind", [UNIGRAM, BPE])
def test_written_model(tmp_path, kind, squeeze):
    path = str(tmp_path / "small.model")
    with open(path, "wb") as file:
        file.write(model_file(kind, squeeze))
    own, original, some = pieces.Codec(path, verify=True), SentencePieceProcessor(model_file=path), texts(400)
    assert own.spec["kind"] == kind and own.by_unit
    made = own.encode_batch(some)
    assert [m.tolist() for m in made] == original.encode(some)
    assert [own.decode(m.tolist()) for m in made] == [original.decode(m.tolist()) for m in made]
    assert all(own.verified(some, made)) and not own.wrong


def test_a_wrong_unit_is_told():
    own = pieces.Codec(queries.tokenizer_file("piece_bpe_32k.model"), verify=True)
    some = ["right and wrong", "right", "spaces at the end  ", ""]
    units = {u for t in some for u in pieces.UNITS.findall(own.normalise(t))}
    ids = {u: b"".join(m.tobytes() for m in own.encode_batch([u[1:].replace(MARK, " ")])) for u in units if u[-1] != MARK}
    own._compare(ids)
    assert not own.wrong
    own._compare({**ids, MARK + "wrong": b"\x01\0\0\0"})
    assert own.wrong == {MARK + "wrong"}
    assert own.verified(some, own.encode_batch(some)) == [False, True, True, True]


def test_query_verifies_every_row(spark):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    rows = [(1, "one text"), (2, None), (3, ""), (4, "one  text "), (5, "日本 \U0001f600 é\n\tx"), (6, "a" * 50_000), (7, " " * 3_000)]
    got = {r["doc_id"]: r for r in pieces.digests(spark.createDataFrame(rows, "doc_id long, text string"), path, verify=True).collect()}
    assert len(got) == len(rows) and all(r["parity"] and r["round_trip"] for r in got.values())

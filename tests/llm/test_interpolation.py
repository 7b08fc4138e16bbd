"""Language-model scores against plain counters."""

import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import interpolation, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
SCHEMA = "doc_id long, text string, n long, kind string, shard int, score double"


def tokens_of(text):
    return [w.decode() for w in (text or "").encode().translate(interpolation.ngrams.LOWER).split()] + [None]


def is_held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 1


def slow(rows, weights, order):
    """Per row: tokens, known, base score, score; counts over all training rows."""
    counts = [Counter() for _ in range(order + 1)]
    for i, text in rows:
        if not is_held_out(i):
            t = ["<s>"] * (order - 1) + tokens_of(text)
            for n in range(1, order + 1):
                counts[n].update(tuple(t[k - n + 1 : k + 1]) for k in range(order - 1, len(t)))
            counts[0].update({"docs": 1})
    total, distinct = sum(counts[1].values()), len(counts[1])
    out = []
    for i, text in rows:
        t = ["<s>"] * (order - 1) + tokens_of(text)
        base = score = 0.0
        known = 0
        for k in range(order - 1, len(t)):
            c = counts[1][(t[k],)]
            known += c > 0
            base += math.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
            p = 1 / (distinct + 1)
            w = weights[1][0]
            p = w * (c / total if total else 0) + (1 - w) * p
            for n in range(2, order + 1):
                context = tuple(t[k - n + 1 : k])
                seen = counts[0]["docs"] if set(context) == {"<s>"} else counts[n - 1][context]
                w = weights[n][seen.bit_length()]
                p = w * (counts[n][tuple(t[k - n + 1 : k + 1])] / seen if seen else 0) + (1 - w) * p
            score += math.log10(p)
        out.append((i, is_held_out(i), len(t) - order + 1, known, total, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_small_corpus(spark, order):
    rng = np.random.default_rng(order)
    words = ["The", "cat", "sat\x0b", "on", "é", "mat.", " ", "dog"]
    rows = [(int(i), " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(300)]
    rows += [(None, "the cat"), (7, None), (7, ""), (7, ""), (8, "new words " * 5), (9, "the cat " * 40_000)]
    df = spark.createDataFrame([(*r, 1, "k", 1, 0.5) for r in rows], SCHEMA).repartition(3)
    model = interpolation.fit(df, order=order, shard_tokens=500)
    same(interpolation.score(model).collect(), slow(rows, model.weights, order))


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert interpolation.score(interpolation.fit(none)).count() == 0
    alone = spark.createDataFrame([(None, "a b", 1, "", 1, 0.0)], SCHEMA)
    same(interpolation.score(interpolation.fit(alone)).collect(), [(None, True, 3, 0, 0, 0.0, 0.0)])


@needs_data
def test_weights_beat_equal_ones_and_the_base(spark):
    """Held-out rows of the table: learned weights do better than one half each, and than single words."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    model = interpolation.fit(docs)
    got = queries.op11_interpolation(spark, SF_DIR).collect()
    same(got, slow(rows, model.weights, model.order))
    halves = np.full_like(model.weights, 0.5)
    plain = slow(rows, halves, model.order)
    held = lambda rs, k: sum(r[k] for r in rs if r[1])
    assert held(got, 6) > held(plain, 6) and held(got, 6) > held(got, 5)

"""Collocations against plain counters; the permutation against its inverse."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import collocations, ngrams, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
SCHEMA = "doc_id long, text string, lang string, grp string, rank long, n long, word string"


def slow(rows, least, top, longest=5):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for k in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[k : k + n])] += 1
    out = []
    for lang, f in counts.items():
        n, rows_ = total[lang], []
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {}
        for p, a in some.items():
            for m in range(2, len(p)):
                for k in range(len(p) - m + 1):
                    covered[p[k : k + m]] = max(covered.get(p[k : k + m], 0), a)
        for p, a in some.items():
            if covered.get(p, 0) < a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]], n))
        out += [(lang, i, p.decode(), -a, le, r, n, -s) for i, (s, a, p, le, r, n) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("b", [2, 7, 12, 13, 21, 24])
def test_permutation_is_invertible_and_lossless(b):
    rng = np.random.default_rng(b)
    for n in range(2, 6):
        ids = [rng.integers(0, 1 << b, 5000).astype(np.uint64) for _ in range(n)]
        widths = collocations.halves(n, b)
        packed = collocations.pack(ids, b)
        assert all((p >> np.uint64(w) == 0).all() for p, w in zip(packed, widths, strict=True))
        mixed = collocations.permute(*packed, widths)
        assert all((p >> np.uint64(w) == 0).all() for p, w in zip(mixed, widths, strict=True))
        back = collocations.unpack(*collocations.restore(*mixed, widths), n, b)
        assert all((x == y).all() for x, y in zip(ids, back, strict=True))


@pytest.mark.parametrize("b", [3, 13])
def test_filters_of_shards_merge_to_plain_counts(b):
    rng = np.random.default_rng(1)
    shards = [rng.integers(0, 5, 3000).astype(np.uint64) for _ in range(4)]
    for n in (2, 3, 5):
        want = Counter()
        for s in shards:
            want.update(g for g in zip(*(s[k : len(s) - n + 1 + k].tolist() for k in range(n)), strict=True) if 0 not in g)
        got, slices = Counter(), {}
        for s in shards:
            for row in collocations.filters(s, n, b, 4, {"grp": "x"}):
                slices.setdefault(row["slice"], []).append(row)
        for rows in slices.values():
            for *ids, counts in collocations.merged(iter(rows), n, b, 4, 3, hold=500):
                got.update(dict(zip(zip(*(i.tolist() for i in ids), strict=True), counts.tolist(), strict=True)))
        assert got == {g: c for g, c in want.items() if c >= 3}


def test_random_texts(spark):
    rng = random.Random(5)
    words = ["Ab", "c", "dé", "E", "f-g", " h", "x\x0by", "rare"]
    rows = []
    for k in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "!"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "en", None, "und", "de"]), text))
    rows += [("hot", "one two three four five six " * 200), ("hot", "one two three four five six " * 200), ("hot", None), (None, ""), ("fr", "   ")]
    rows += [("long", "word " * 300_000)]
    df = spark.createDataFrame([(k % 7 or None, t, lang, "g", 1, 1, "w") for k, (lang, t) in enumerate(rows)], SCHEMA).repartition(4)
    assert found(collocations.collocations(df, least=8, top=40, shard_tokens=3000)) == slow(rows, 8, 40)


def test_no_texts(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, None, None, "", 1, 1, "")], SCHEMA)).count() == 0


@needs_data
def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()]
    assert found(queries.op12_collocations(spark, SF_DIR)) == slow(rows, 100, 2000)


def test_numbers_survive_squeezing():
    rng = np.random.default_rng(2)
    for values in (np.zeros(0), np.zeros(5), rng.integers(0, 2**63, 999), np.array([2**64 - 1], np.uint64)):
        values = values.astype(np.uint64)
        assert (ngrams.widen(ngrams.squeeze(values), len(values)) == values).all()

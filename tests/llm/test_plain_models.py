"""Learned parts against plain loops: the label model, the distances of the quality rules, compressed sizes."""

from __future__ import annotations

import math
import os
from collections import Counter

import numpy as np
import pytest
import regex
import zstandard

from ledgerlake.llm import langid, quality, toxicity

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def plain_shares(votes, posterior, rates):
    """1 over 1 plus a voter's correlations above one half with the others, the stronger of both classes."""
    n, shares = len(votes[0]), []
    for i in range(n):
        total = 0.0
        for j in range(n):
            if i == j:
                continue
            strongest = 0.0
            for side in (0, 1):
                cover = {(a, b): 0.0 for a in (i, j) for b in (i, j)}
                for row, p in zip(votes, posterior, strict=True):
                    weight = p if side == 0 else 1 - p
                    gap = {a: ((row[a] == 1) - rates[side][a]) if row[a] >= 0 else 0.0 for a in (i, j)}
                    for a, b in cover:
                        cover[a, b] += weight * gap[a] * gap[b]
                strongest = max(strongest, abs(cover[i, j] / math.sqrt(cover[i, i] + 2) / math.sqrt(cover[j, j] + 2)))
            total += strongest if strongest > 0.5 else 0.0
        shares.append(1 / (1 + total))
    return shares


def plain_em(votes, rounds, start, label_share):
    posterior, n = [min(max(p, 0.02), 0.98) for p in start], len(votes[0])
    shares, rates = [1.0] * n, [[0.5] * n, [0.5] * n]
    for turn in range(rounds):
        prior = sum(posterior) / len(posterior) if label_share is None else label_share
        prior = min(max(prior, 1e-3), 0.5)
        for side in (0, 1):
            for v in range(n):
                fired = known = 0.0
                for row, p in zip(votes, posterior, strict=True):
                    weight = p if side == 0 else 1 - p
                    fired += weight * (row[v] == 1)
                    known += weight * (row[v] >= 0)
                rates[side][v] = min(max((fired + 0.05) / (known + 0.1), 1e-5), 1 - 1e-5)
        if turn % 10 == 0:
            shares = plain_shares(votes, posterior, rates)
            if label_share is not None:
                shares[-1] = 1.0
        for k, row in enumerate(votes):
            odds = math.log(prior / (1 - prior))
            for v, vote in enumerate(row):
                if vote == 1:
                    odds += shares[v] * math.log(rates[0][v] / rates[1][v])
                elif vote == 0 and (label_share is None or v == n - 1):
                    odds += shares[v] * math.log((1 - rates[0][v]) / (1 - rates[1][v]))
            posterior[k] = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
    return posterior, rates[0], rates[1], shares


@pytest.mark.parametrize("label_share", [None, 0.2])
@pytest.mark.parametrize("seed", [1, 2])
def test_label_model_against_loops(seed, label_share):
    rng = np.random.default_rng(seed)
    truth = rng.random(80) < 0.25
    votes = np.array([[int(rng.random() < (0.7 if t else 0.08)) for _ in range(4)] for t in truth])
    votes = np.hstack([votes, votes[:, :1], truth[:, None].astype(int)])  # a twin, and the label
    votes[rng.random(votes.shape) < 0.1] = -1
    votes[:, -1] = truth
    start = np.where(truth, 0.9, 0.05)
    got = toxicity.label_model(votes, rounds=13, start=start, label_share=label_share)
    want = plain_em(votes.tolist(), 13, start.tolist(), label_share)
    for a, b in zip(got, want, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-8, atol=1e-10)


def histograms(text, listed):
    """Class counts and common-word counts of a text, all other words under an empty name."""
    blank = len(regex.findall(r"[\x20\x09-\x0D]", text))
    named = [len(regex.findall(p, text)) for p in (r"\p{Lu}", r"[#*$%&|<>]", r"[.,;:!?'\"()0-9-]")]
    words = regex.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(text) - blank - sum(named), named[0], blank, *named[1:]], Counter(w if w in listed else "" for w in words)


def distance(p, q):
    """Jensen-Shannon distance of two count histograms."""
    total = 0.0
    sp, sq = max(1, sum(p.values())), max(1, sum(q.values()))
    for k in {*p, *q}:
        a, b = p.get(k, 0) / sp, q.get(k, 0) / sq
        total += sum(x * math.log2(x / ((a + b) / 2)) / 2 for x in (a, b) if x > 0)
    return math.sqrt(max(0.0, total))


@needs_data
def test_quality_distances_of_every_document(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r["doc_id"]: r for r in quality.quality(docs).collect()}
    listed = {w for words in quality.COMMON.values() for w in words}
    made = {r["doc_id"]: (r["lang"], *histograms(r["text"] or "", listed)) for r in docs.collect()}
    assert {lang for lang, _, _ in made.values()} - {None} <= set(quality.COMMON)
    sums = {}
    for i, (lang, classes, words) in made.items():
        if lang is not None and not got[i]["base_failed"]:
            whole = sums.setdefault(lang, (Counter(), Counter()))
            whole[0].update(dict(enumerate(classes)))
            whole[1].update(words)
    assert len(sums) > 1 and len(got) == len(made)
    near = 0
    for i, (_, classes, words) in made.items():
        each = [(distance(words, w), distance(dict(enumerate(classes)), c), k) for k, (c, w) in sums.items()]
        by_word, by_class, _ = min(each)
        row = got[i]
        if words:
            assert row["by_word"] == pytest.approx(by_word, abs=1e-6)
        if min(abs(by_word - quality.MAX_WORD), abs(by_class - quality.MAX_CLASS)) < 1e-6:
            near += 1
            continue
        assert row["kept"] == (not row["base_failed"] and by_word <= quality.MAX_WORD and by_class <= quality.MAX_CLASS)
    assert near <= 1


@needs_data
def test_language_sizes_of_every_document(spark):
    """Blocks compress without loss, and the smallest sum decides; ties go to the language that comes first."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.fit(docs)
    held = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in model.dictionaries]
    unpack = [zstandard.ZstdDecompressor(dict_data=d) for d in held]
    pack = langid._compressors(model)
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        if not r["text"] or not regex.search(r"\p{L}", r["text"]):
            assert got[r["doc_id"]]["lang_pred"] == "und"
            continue
        data, total = r["text"].lower().encode(), [0] * len(pack)
        for k, (squeeze, back) in enumerate(zip(pack, unpack, strict=True)):
            for at in range(0, len(data), langid.BLOCK):
                block = squeeze.compress(data[at : at + langid.BLOCK])
                assert back.decompress(block, max_output_size=langid.BLOCK) == data[at : at + langid.BLOCK]
                total[k] += len(block)
        least = min(total)
        assert got[r["doc_id"]]["lang_pred"] == model.languages[total.index(least)]
        odds = sum(math.exp(-min((t - least) / langid.TEMPERATURE, 60)) for t in total)
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / odds)
        second = sorted(total)[1]
        assert got[r["doc_id"]]["confident"] == ((second - least) * 1000 >= langid.MARGIN * len(r["text"]))

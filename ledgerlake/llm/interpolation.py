"""Language-model scores by deleted interpolation.

Maximum-likelihood estimates of n-grams of all training documents are mixed from the longest context down to single
tokens and a uniform share: ``P_n = w_n ML_n + (1 - w_n) P_(n-1)``. The weight ``w_n`` depends on the bucket of the context's
frequency (its number of binary digits). Weights are learned with expectation-maximisation on counts of one training
document in ten, against the counts of the other nine; the counts that score are those of all training documents.

Tokens are words after A-Z became a-z, then one end per document; contexts do not reach over the start. Counts of words
go by their text, those of longer n-grams by a 64-bit hash of the words' 64-bit hashes. The driver sees the
weights (one per bucket) and totals. A null text is an empty one: one token, the end. A row without an id is
held out. Repeated rows are scored alike; further columns are not read; an empty table gives an empty result. Without training
rows every token has the same share. A text of any length is one row of a shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import ngrams
from ledgerlake.llm.common import stored, whole_texts

#: Longest n-gram; rounds of expectation-maximisation at most, and the change of a weight that ends them.
ORDER, ROUNDS, CHANGE = 2, 30, 1e-3
REST, DEVELOP, HELD_OUT = 0, 1, 2
BUCKETS = 65  # a count has at most 64 binary digits

ANSWER_SCHEMA = "level int, slice int, shard long, n int, extra binary, total binary, rest binary, n_distinct long"
ANSWER_ARROW = pa.schema([
    ("level", pa.int32()), ("slice", pa.int32()), ("shard", pa.int64()), ("n", pa.int32()), ("extra", pa.binary()),
    ("total", pa.binary()), ("rest", pa.binary()), ("n_distinct", pa.int64()),
])


def split(text: bytes) -> list[bytes]:
    return [*text.translate(ngrams.LOWER).split(), ngrams.END]


@dataclass(frozen=True)
class Model:
    shards: DataFrame
    answers: DataFrame
    bits: int
    order: int
    total: tuple[int, int]  # training tokens of all documents, and of those the weights were not learned on
    distinct: int
    weights: np.ndarray  # by level and bucket; level 1 has one bucket


def held_out(docs: DataFrame):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(True))


def _contexts(tokens: np.ndarray, order: int) -> list[np.ndarray]:
    """The tokens before each token, nearest first; number 0 stands for the start."""
    out, last = [], None
    for k in range(1, order):
        before = np.concatenate([np.zeros(min(k, len(tokens)), tokens.dtype), tokens[:-k]])
        out.append(before if last is None else np.where(last == 0, 0, before))
        last = out[-1]
    return out


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _gram_keys(tokens: np.ndarray, words: list[bytes], order: int) -> list[np.ndarray]:
    """Keys of the 2-, 3-, … n-grams that end at each token."""
    own = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    keys, last = [], own[tokens]
    for before in _contexts(tokens, order):
        last = _mix(last, own[before])
        keys.append(last)
    return keys


def fit(docs: DataFrame, order: int = ORDER, rounds: int = ROUNDS, shard_tokens: int = ngrams.SHARD_TOKENS) -> Model:
    """Count all training documents, give every shard the counts it needs, and learn the weights."""
    develop = F.pmod(F.xxhash64("doc_id", F.lit("develop")), F.lit(10)) == 0
    kind = F.when(held_out(docs), HELD_OUT).when(develop, DEVELOP).otherwise(REST)
    texts = whole_texts(docs).select(F.lit("").alias("grp"), kind.alias("kind"), "doc_id", "text")
    shards = stored(ngrams.shard_texts(texts, split, shard_tokens), "lm-shards")
    sums = {r["kind"]: r["n"] for r in shards.groupBy("kind").agg(F.sum("n_tokens").alias("n")).collect()}
    bits = ngrams.slice_bits(sum(sums.values()))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in ngrams.rows_of(batches):
            tokens, words = ngrams.widen(row["tokens"], row["n_tokens"]).astype(np.int64), ngrams.words_of(row)
            yield from ngrams.word_requests(row, tokens, words, bits)
            for level, keys in enumerate(_gram_keys(tokens, words, order), 2):
                base = {"level": level, "grp": "", "shard": row["shard"], "kind": row["kind"]}
                left, _, counts = ngrams.distinct(keys)
                yield from ngrams.key_requests(left, None, counts, 64, bits, base)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (_, level, k), rows in ngrams.slices_of(batches):
            rows = list(rows)  # one slice: a bounded part of all keys
            if level == 1:
                index, places = ngrams.asked_words(rows)
                size = len(index)
            else:
                asked = [ngrams.keys_of(r, 64, bits)[0] for r in rows]
                known = ngrams.distinct(np.concatenate(asked))[0]
                places, size = [np.searchsorted(known, a) for a in asked], len(known)
                del asked, known
            total, rest = np.zeros(size, np.int64), np.zeros(size, np.int64)
            for row, at in zip(rows, places, strict=True):
                if row["kind"] != HELD_OUT:
                    counts = ngrams.widen(row["counts"], row["n"]).astype(np.int64)
                    total[at] += counts
                    if row["kind"] == REST:
                        rest[at] += counts
            yield {"level": level, "slice": k, "n_distinct": int(np.count_nonzero(total))}
            for row, at in zip(rows, places, strict=True):
                yield {
                    "level": level, "slice": k, "shard": row["shard"], "n": row["n"], "extra": row["extra"] if level == 1 else None,
                    "total": ngrams.squeeze(total[at]), "rest": ngrams.squeeze(rest[at]) if row["kind"] == DEVELOP else None,
                }

    requests = shards.mapInArrow(lambda b: ngrams.batches_of(ask(b), ngrams.REQUEST_ARROW), ngrams.REQUEST_SCHEMA)
    answers = stored(
        ngrams.by_slice(requests).mapInArrow(lambda b: ngrams.batches_of(answer(b), ANSWER_ARROW), ANSWER_SCHEMA), "lm-answers"
    )
    distinct = answers.where("shard is null and level = 1").agg(F.coalesce(F.sum("n_distinct"), F.lit(0))).first()[0]
    rest, all_ = sums.get(REST, 0), sums.get(REST, 0) + sums.get(DEVELOP, 0)
    model = Model(shards, answers, bits, order, (all_, rest), distinct, np.full((order + 1, BUCKETS), 0.5))
    return Model(shards, answers, bits, order, (all_, rest), distinct, _weights(model, rounds))


def _resolved(model: Model, only: int | None = None) -> DataFrame:
    """Shards with their answers."""
    shards = model.shards if only is None else model.shards.where(F.col("kind") == only)
    given = model.answers.where("shard is not null").join(shards.select("shard"), "shard", "left_semi") if only is not None else model.answers.where("shard is not null")
    held = given.groupBy("shard").agg(F.collect_list(F.struct("level", "slice", "n", "extra", "total", "rest")).alias("answers"))
    return shards.join(held, "shard")


def _estimates(row: dict, order: int, which: str, tokens_in_all: int):
    """For each token: its count, its estimates by level, and the counts of its contexts by level from 2 on."""
    tokens, words = ngrams.widen(row["tokens"], row["n_tokens"]).astype(np.int64), ngrams.words_of(row)
    by_level: dict[int, list] = {}
    for a in sorted(row["answers"], key=lambda a: (a["level"], a["slice"])):
        by_level.setdefault(a["level"], []).append(a)
    words_seen = np.zeros(len(words), np.int64)
    for a in by_level[1]:
        words_seen[np.cumsum(ngrams.widen(a["extra"], a["n"]).astype(np.int64))] = ngrams.widen(a[which], a["n"])
    seen = [words_seen[tokens]]
    estimates = [seen[0] / max(tokens_in_all, 1)]
    frequencies = []
    context = words_seen[_contexts(tokens, 2)[0]] if order > 1 else None  # the start is as frequent as the end
    for level, keys in enumerate(_gram_keys(tokens, words, order), 2):
        known = ngrams.distinct(keys)[0]
        counts = np.concatenate([ngrams.widen(a[which], a["n"]).astype(np.int64) for a in by_level[level]])
        here = counts[np.searchsorted(known, keys)]
        frequencies.append(context)
        estimates.append(here / np.maximum(context, 1))
        seen.append(here)
        if level < order:  # the context of the next level is the n-gram of this level that ends one token earlier
            first = _contexts(tokens, 2)[0] == 0
            context = np.where(first, words_seen[0], np.concatenate([here[:1], here[:-1]]))
    return seen[0], estimates, frequencies


def _buckets(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1] * (counts > 0)


def _weights(model: Model, rounds: int) -> np.ndarray:
    """Expectation-maximisation over the tokens of the documents kept for it; each round is one pass over stored estimates."""
    order, rest, floor = model.order, model.total[1], 1 / (model.distinct + 1)

    def estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in ngrams.rows_of(batches):
            _, levels, contexts = _estimates(row, order, "rest", rest)
            whole = np.column_stack([*levels, *[_buckets(c) for c in contexts]]).astype("<f8")
            for a in range(0, len(whole), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array([whole[a : a + (1 << 17)].tobytes()], pa.binary())], names=["part"])

    parts = stored(_resolved(model, DEVELOP).mapInArrow(estimates, "part binary"), "lm-estimates")
    weights, reached = np.full((order + 1, BUCKETS), 0.5), np.zeros((order + 1, BUCKETS), bool)
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((order + 1, BUCKETS, 2))
            for row in ngrams.rows_of(batches):
                whole = np.frombuffer(row["part"], "<f8").reshape(-1, 2 * order - 1)
                left = np.ones(len(whole))
                levels, buckets = whole[:, :order], whole[:, order:].astype(np.int64)
                p = mixtures(levels, buckets, weights, floor)
                for level in range(order, 0, -1):
                    b = buckets[:, level - 2] if level > 1 else np.zeros(len(whole), np.int64)
                    taken = left * weights[level][b] * levels[:, level - 1] / p[level]
                    sums[level, :, 0] += np.bincount(b, taken, BUCKETS)
                    sums[level, :, 1] += np.bincount(b, left, BUCKETS)
                    left = left - taken
            at = np.argwhere(sums[:, :, 1] > 0)
            columns = [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(sums[at[:, 0], at[:, 1], 0]), pa.array(sums[at[:, 0], at[:, 1], 1])]
            yield pa.RecordBatch.from_arrays(columns, names=["level", "bucket", "taken", "reached"])

        got = parts.mapInArrow(expect, "level int, bucket int, taken double, reached double").groupBy("level", "bucket")
        learned = weights.copy()
        for r in got.agg(F.sum("taken").alias("taken"), F.sum("reached").alias("reached")).collect():
            learned[r["level"], r["bucket"]] = min(max(r["taken"] / r["reached"], 0.0), 1 - 1e-6)
            reached[r["level"], r["bucket"]] = True
        moved = np.abs(learned - weights).max()
        weights = learned
        if moved < CHANGE:
            break
    weights[2:, 0] = 0  # a context that was never seen says nothing
    if not model.total[0]:
        weights[1] = 0
    for level in range(2, order + 1):
        for b in range(2, BUCKETS):
            if not reached[level, b]:  # as for the next rarer contexts
                weights[level, b] = weights[level, b - 1]
    return weights


def mixtures(levels: np.ndarray, buckets: np.ndarray, weights: np.ndarray, floor: float) -> list[np.ndarray]:
    """Probabilities by level; level 0 is the uniform share."""
    out = [np.full(len(levels), floor)]
    for level in range(1, weights.shape[0]):
        w = weights[level][buckets[:, level - 2]] if level > 1 else weights[1][0]
        out.append(w * levels[:, level - 1] + (1 - w) * out[-1])
    return out


def score(model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    order, (total, _), distinct, weights = model.order, model.total, model.distinct, model.weights
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
        ("base_score", pa.float64()), ("score", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in ngrams.rows_of(batches):
            sizes = np.array(row["sizes"], np.int64)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            seen, levels, contexts = _estimates(row, order, "total", total)
            buckets = np.column_stack([_buckets(c) for c in contexts]) if contexts else np.zeros((len(seen), 0), np.int64)
            p = mixtures(np.column_stack(levels), buckets, weights, 1 / (distinct + 1))[order]
            base = np.log10((seen + 0.5) / (total + 0.5 * (distinct + 1)))
            columns = [
                pa.array(row["docs"], pa.int64()), pa.array([row["kind"] == HELD_OUT] * len(sizes)), pa.array(sizes),
                pa.array(np.add.reduceat((seen > 0).astype(np.int64), starts)), pa.array(np.full(len(sizes), total, np.int64)),
                pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(p), starts)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return _resolved(model).mapInArrow(run, out)

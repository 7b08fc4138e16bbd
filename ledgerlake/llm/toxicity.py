"""Toxicity by weak supervision.

Voters (word lists, patterns, and stems that labelled rows point to) fire or stay silent on each whole text. A generative label model, fitted with EM
on the voters' firings, estimates how often each voter fires on toxic and on clean texts; voters that agree
far more than their class explains share their weight. Where a row has a label, the label is one more, fallible
voter, and the one that EM starts from. The model's posteriors are the soft targets of a logistic regression, which scores every text. Its
features reach beyond the voters: besides single words, lists, patterns and stems it has hashed words and character n-grams of
the whole text, those that tell the posteriors apart.

Only a bounded sample of firings (no texts) reaches the driver.
Null and empty texts fire no voter and get the score of the bias. Repeated rows and ties are scored alike. An empty table gives an empty
result; without labelled rows the lists decide.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import held_out, stored, thinned, whole_texts

# Insults by theme, in the four languages of the corpus.
LEXICONS: dict[str, list[str]] = {
    "mind": ["idiot", "idiots", "moron", "morons", "stupid", "dumb", "imbecile", "cretin", "dimwit", "dummkopf",
             "dumm", "blöd", "trottel", "imbécile", "crétin", "débile", "estúpido", "estúpida", "idiota", "imbécil"],
    "worth": ["worthless", "pathetic", "loser", "losers", "useless", "failure", "versager", "nutzlos", "wertlos",
              "erbärmlich", "minable", "inútil", "patético", "patética", "perdedor", "lamentable"],
    "filth": ["scum", "trash", "garbage", "filth", "filthy", "vermin", "abschaum", "dreck", "ungeziefer", "ordure",
              "racaille", "vermine", "escoria", "basura"],
    "disgust": ["disgusting", "revolting", "repulsive", "ekelhaft", "widerlich", "dégoûtant", "répugnant",
                "asqueroso", "asquerosa", "repugnante"],
    "mockery": ["clown", "clowns", "freak", "creep", "coward", "pig", "witzfigur", "feigling", "bouffon", "lâche",
                "payaso", "cobarde"],
}

# Patterns that hint at abuse; the label model learns which of them are worth anything. Each has letters
# that must be there before it is tried.
PATTERNS: dict[str, tuple[tuple[str, ...], re.Pattern]] = {
    "address": ((" you ", " du ", " tu ", " eres ", " vous "), re.compile(r" (?:you|du|tu|eres|vous) (?:are |re |bist |es )?(?:an? |so |such |ein |un )")),
    "shouting": (("!!!",), re.compile(r"!{3}")),
}
WORD = re.compile(r"[^\W\d_]+")

THRESHOLD = 0.7
#: Rows whose firings reach the driver; labelled rows the stems are learned from; most stems.
SAMPLE_ROWS, STEM_ROWS, STEMS = 10_000, 12_000, 100
#: Bits of a hashed n-gram; sizes of character n-grams; most n-grams that the classifier has.
HASH_BITS, SIZES, GRAMS = 18, (3, 4, 5), 400
#: How much rarer than once among all candidates chance may make what is learned from labels (natural logarithm).
CERTAIN = 5.0


#: Weight of a theme of the lists, and bias, as expected; rows decide where there are enough of them.
THEME_WEIGHT, BIAS = 8.0, -5.0


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]
    stems: tuple[str, ...]
    fires_toxic: dict[str, float]
    fires_clean: dict[str, float]
    shares: dict[str, float]
    grams: tuple[int, ...] = ()


def _themes() -> dict[str, str]:
    return {word: theme for theme, words in LEXICONS.items() for word in words}


def grams_of(word: str) -> set[int]:
    """Hashes of a word and of its character n-grams, borders included."""
    marked, mask = f"<{word}>", (1 << HASH_BITS) - 1
    found = {zlib.crc32(f"={word}".encode()) & mask}
    for size in SIZES:
        found.update(zlib.crc32(marked[k : k + size].encode()) & mask for k in range(len(marked) - size + 1))
    return found


class Voters:
    """Everything that can fire on a text: words of the lists, their themes (``=theme``), patterns (``~name``), stems (``stem*``),
    hashed n-grams (``#hash``). What a word fires is looked up; the table of known words is emptied when it is full."""

    def __init__(self, stems: tuple[str, ...] = (), grams: tuple[int, ...] = ()):
        self.themes, self.stems, self.grams = _themes(), tuple(s.rstrip("*") for s in stems), frozenset(grams)
        self.known: dict[str, tuple[str, ...]] = {}

    def of_word(self, word: str) -> tuple[str, ...]:
        found = [word, f"={self.themes[word]}"] if word in self.themes else []
        found += [f"{s}*" for s in self.stems if word.startswith(s)]
        if self.grams:
            found += [f"#{g}" for g in grams_of(word) & self.grams]
        if len(self.known) >= 1 << 19:
            self.known.clear()
        self.known[word] = tuple(found)
        return self.known[word]

    def fired(self, text: str) -> list[str]:
        text = text.lower()
        known, out = self.known, set()
        for word in set(WORD.findall(text)):
            names = known.get(word)
            if names is None:
                names = self.of_word(word)
            if names:
                out.update(names)
        for name, (needs, pattern) in PATTERNS.items():
            if any(n in text for n in needs) and pattern.search(text):
                out.add(f"~{name}")
        return sorted(out)


def _learning_rows(known: DataFrame, rows: int) -> DataFrame:
    """Labelled rows outside the held-out third, lowest hash of the id first."""
    learning = known.where(~held_out(F.col("doc_id")))
    return learning.where(thinned(F.col("doc_id"), rows, learning.count())).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def learned_stems(docs: DataFrame, known: DataFrame, rows: int = STEM_ROWS, most: int = STEMS) -> tuple[str, ...]:
    """Beginnings of words that are found in toxic rows and hardly in clean ones, among at most ``rows`` labelled rows.

    A stem has 2 to 9 letters and needs three toxic rows, or one in a hundred of them, of different texts, and more of
    them than chance brings to the best of all candidates. It is a word of its own or begins three different ones. None
    begins with another. At most ``most`` come back, the most frequent first.
    """
    some = (
        whole_texts(docs)
        .join(F.broadcast(_learning_rows(known, rows)), "doc_id")  # at most ``rows`` ids
        .groupBy(F.xxhash64("text").alias("h"))
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    )
    words = some.select("toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word"))
    per_word = words.where(F.length("word") > 1).groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
    once = stored(per_word, "toxic-words")
    begun = once.select("bad", "word", F.explode(F.array_distinct(F.array(*[F.substring("word", 1, k) for k in range(2, 10)]))).alias("w"))
    # rows with a beginning: at least those of its most frequent word; only candidates are counted row by row
    near = begun.groupBy("w").agg(F.sum("bad").alias("most"), F.count_if(F.col("bad") > 0).alias("words"), F.max((F.col("word") == F.col("w")).cast("int")).alias("own"))
    size = some.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, share = size[0], min(max(size[0] / max(size[1], 1), 1e-6), 0.5)
    least = max(3, toxic / 100)
    possible = begun.join(near.where((F.col("most") >= least) & ((F.col("words") >= 3) | (F.col("own") == 1))), "w").select("w", "word")
    tried = near.count()
    listed = some.select("h", "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word"))
    counts = listed.join(possible, "word").groupBy("w", "h").agg(F.max("toxic").alias("toxic")).groupBy("w").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n"))
    rate = F.col("bad") / F.col("n")
    surprise = F.col("n") * (rate * F.log(rate / share) + F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0))
    good = counts.where((F.col("bad") >= least) & (F.col("bad") >= 0.8 * (F.col("n") + 0.5)) & (surprise >= math.log(max(tried, 1)) + CERTAIN))
    chosen: list[str] = []
    for r in good.orderBy(F.desc("bad"), F.length("w"), "w").limit(20 * most).collect():
        if len(chosen) < most and not any(r["w"].startswith(c) or c.startswith(r["w"]) for c in chosen):
            chosen.append(r["w"])
    return tuple(f"{c}*" for c in chosen)


def label_model(
    votes: np.ndarray, rounds: int = 60, start: np.ndarray | None = None, label_share: float | None = None
) -> tuple[np.ndarray, ...]:
    """EM over fallible voters: posterior of each row, firing rates on toxic and clean, share of each voter.

    ``votes`` has 1 (fired), 0 (silent) or -1 (has no opinion). A voter's share is 1 over 1 plus its absolute
    correlations with the others inside the classes, so twins together count about once. With ``label_share``, the
    share of toxic labels, the last column is the label and the class balance is that share; all other voters then abstain when
    they are silent, as a word list of one language does on texts of another.
    """
    heard = np.ones(votes.shape[1])
    if label_share is not None:
        heard[:-1] = 0
    fired, known = (votes == 1).astype(float), (votes >= 0).astype(float)
    posterior = np.clip(start if start is not None else fired.mean(1), 0.02, 0.98)
    shares = np.ones(votes.shape[1])
    rates = np.full((2, votes.shape[1]), 0.5)
    for turn in range(rounds):
        prior = np.clip(posterior.mean() if label_share is None else label_share, 1e-3, 0.5)
        for k, weight in enumerate((posterior, 1 - posterior)):
            rates[k] = (weight @ fired + 0.05) / (weight @ known + 0.1)
        rates = np.clip(rates, 1e-5, 1 - 1e-5)
        if turn % 10 == 0:  # from the first round on, before twins can draw the posterior to themselves
            shares = _shares(fired, known, posterior, rates)
            if label_share is not None:
                shares[-1] = 1
        gain = fired * np.log(rates[0] / rates[1]) + (known - fired) * heard * np.log((1 - rates[0]) / (1 - rates[1]))
        odds = np.log(prior / (1 - prior)) + gain @ shares
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return posterior, rates[0], rates[1], shares


def _shares(fired, known, posterior, rates) -> np.ndarray:
    total = np.zeros((fired.shape[1],) * 2)
    for weight, rate in ((posterior, rates[0]), (1 - posterior, rates[1])):
        gap = (fired - rate) * known
        cover = (gap * weight[:, None]).T @ gap
        scale = np.sqrt(np.diag(cover) + 2.0)  # few firings show no correlation
        total = np.maximum(total, np.abs(cover / scale[:, None] / scale[None, :]))
    np.fill_diagonal(total, 0)
    return 1 / (1 + np.where(total > 0.5, total, 0).sum(1))


def logistic(features: np.ndarray, targets: np.ndarray, expected: np.ndarray, ridge: float | np.ndarray = 0.05, steps: int = 30) -> np.ndarray:
    """Newton steps for soft targets, drawn to the expected weights; the last weight is the bias. A step is halved until it helps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    expected = np.append(expected, BIAS)
    w, shrink = expected.copy(), np.zeros(x.shape[1]) + ridge

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.sum(np.logaddexp(0, z) - targets * z) + 0.5 * np.sum(shrink * (w - expected) ** 2))

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - targets) + shrink * (w - expected)
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(shrink + 1e-6)
        step, size = np.linalg.solve(bend, slope), 1.0
        while (then := loss(w - size * step)) > now and size > 1e-4:
            size /= 2
        if now - then < 1e-6 * max(1.0, now):
            break
        w, now = w - size * step, then
    return w


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from rows outside the held-out third.

    Of at most ``sample_rows`` labelled rows the names that fired and the label reach the driver.
    Without rows the themes of the lists decide with their expected weights.
    """
    known = labels.where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    learned = learned_stems(docs, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(learned)
        for batch in batches:
            fired = pa.array([voters.fired(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), fired], names=["toxic", "fired"])

    some = stored(whole_texts(docs).join(F.broadcast(_learning_rows(known, sample_rows)), "doc_id").select("toxic", "text"), "toxic-sample")
    rows = some.mapInArrow(run, "toxic int, fired array<string>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["fired"]))
    extra = list(learned)
    names = [*_themes(), *extra, *[f"={t}" for t in LEXICONS], *[f"~{p}" for p in PATTERNS]]
    expected = [THEME_WEIGHT if n[0] == "=" else 0.0 for n in names]
    x = _matrix(rows, names)
    if not len(rows) or not (x.any() or any(r["toxic"] for r in rows)):
        return Model(BIAS, dict(zip(names, expected, strict=True)), learned, {}, {}, {})
    at = {name: k for k, name in enumerate(names)}
    voters = [n for n in names if n[0] in "=~"] + extra + ["label"]
    toxic = np.array([[r["toxic"]] for r in rows])
    votes = np.hstack([x[:, [at[n] for n in voters[:-1]]], toxic])
    hinted = x[:, [at[n] for n in [*extra, *[f"={t}" for t in LEXICONS]]]].any(1)
    start = np.where(toxic[:, 0] > 0, 0.9, np.where(hinted, 0.5, 0.02))
    prior = float(np.clip(toxic.mean(), 1e-3, 0.5))
    _, fires_toxic, fires_clean, shares = label_model(votes, start=start, label_share=prior)
    by = lambda values: dict(zip(voters, map(float, values), strict=True))
    rates = Model(0.0, {}, learned, by(fires_toxic), by(fires_clean), by(shares))
    grams = learned_grams(some, rates, prior)
    names, expected = names + [f"#{g}" for g in grams], np.array(expected + [0.0] * len(grams))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(learned, grams)
        for batch in batches:
            fired = pa.array([voters.fired(t) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), fired], names=["toxic", "fired"])

    rows = some.mapInArrow(features, "toxic int, fired array<string>").collect()
    rows.sort(key=lambda r: (r["toxic"], r["fired"]))
    targets = np.array([posterior_of(rates, prior, r["fired"], r["toxic"]) for r in rows])
    weights = logistic(_matrix(rows, names), targets, expected, ridge=np.array([0.05 if n[0] != "#" else 1.0 for n in names] + [0.05]))
    return Model(float(weights[-1]), dict(zip(names, map(float, weights), strict=False)), learned, rates.fires_toxic, rates.fires_clean, rates.shares, grams)


def _matrix(rows: list, names: list[str]) -> np.ndarray:
    at = {name: k for k, name in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for k, row in enumerate(rows):
        x[k, [at[n] for n in row["fired"]]] = 1
    return x


def posterior_of(rates: Model, prior: float, fired: list[str], label: int) -> float:
    """The label model's posterior of one row."""
    seen, odds = {*fired, *(["label"] if label else [])}, math.log(prior / (1 - prior))
    for voter, toxic in rates.fires_toxic.items():
        clean = rates.fires_clean[voter]
        if voter in seen:
            odds += rates.shares[voter] * math.log(toxic / clean)
        elif voter == "label":  # the others abstain when they are silent
            odds += rates.shares[voter] * math.log((1 - toxic) / (1 - clean))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def learned_grams(some: DataFrame, rates: Model, prior: float, most: int = GRAMS) -> tuple[int, ...]:
    """Hashed words and character n-grams that tell the posteriors apart, beyond what chance brings among all: strongest first.

    ``some``: the sample, ``toxic, text``. Each task sums posteriors per hash (at most ``2**HASH_BITS`` rows of a task).
    """
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, known = Voters(rates.stems), {}
        total = np.zeros((2, 1 << HASH_BITS))
        rows = np.zeros(2)
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                p = posterior_of(rates, prior, voters.fired(text), label)
                found: set[int] = set()
                for word in set(WORD.findall(text.lower())):
                    if word not in known:
                        if len(known) >= 1 << 17:
                            known.clear()
                        known[word] = np.fromiter(grams_of(word), np.int64)
                    found.update(known[word].tolist())
                at = np.fromiter(found, np.int64, len(found))
                total[0, at] += 1
                total[1, at] += p
                rows += (1, p)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[0, at], rows[0])), pa.array(np.append(total[1, at], rows[1]))], names=["g", "n", "bad"]
        )

    counts = stored(some.mapInArrow(sums, "g long, n double, bad double").groupBy("g").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "toxic-grams")
    whole = counts.where("g < 0").first()
    if whole is None or not 0 < whole["bad"] < whole["n"]:
        return ()
    share = min(max(whole["bad"] / whole["n"], 1e-6), 0.5)
    rate = F.least(F.greatest(F.col("bad") / F.col("n"), F.lit(1e-9)), F.lit(1 - 1e-9))
    surprise = F.col("n") * (rate * F.log(rate / share) + (1 - rate) * F.log((1 - rate) / (1 - share)))
    strong = counts.where((F.col("g") >= 0) & (rate >= 0.5)).select("g", surprise.alias("s")).where(F.col("s") >= math.log(1 << HASH_BITS) + CERTAIN)
    return tuple(r["g"] for r in strong.orderBy(F.desc("s"), "g").limit(most).collect())


def _scorer(model: Model):
    """Probability of a text under the classifier."""
    voters, weights, bias = Voters(model.stems, model.grams), model.weights, model.bias
    return lambda text: 1 / (1 + math.exp(-max(-60.0, min(60.0, bias + sum(weights.get(n, 0.0) for n in voters.fired(text))))))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, key: str = "doc_id") -> DataFrame:
    """``doc_id, score, predicted`` for every row; the score is the classifier's probability."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = _scorer(model)
        for batch in batches:
            scores = [value(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "score", "predicted"])

    return whole_texts(docs, key).mapInArrow(run, f"{key} long, score double, predicted int")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` for the rows the classifier does not reject."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = _scorer(model)
        for batch in batches:
            yield batch.filter(pa.array([value(t or "") < threshold for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

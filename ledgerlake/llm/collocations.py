"""Phrase collocations by counting quotient filters.

Per language the words that are frequent enough get numbers; a phrase with a rarer word cannot be frequent itself. Every
contiguous n-gram of 2 to 5 numbered words is packed into a whole number and permuted by an invertible Feistel network. The
leading bits (quotient) name the slot range, the other bits (remainder) are kept whole, so counters are lossless and compact:
sorted remainders in small steps beside their counts. Each shard makes a sorted filter of its own; the filters
of one quotient range are merged, whatever shard they come from. Words, and phrases that reach the threshold, are turned
back by the inverse permutation. Pairs are merged first; each shard learns which of its pairs reach the threshold, and
counts longer phrases only where all their pairs do.

Scores use exact whole numbers: products in decimals of 38 digits, floors by whole division. A null text is empty, a null
language is ``und``. Rows may repeat and lack ids: every row counts. Further columns are not read. An empty table gives an
empty result. A phrase whose score, count and text tie with none other has one place; texts differ, so ties end there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import ngrams
from ledgerlake.llm.common import stored

LONGEST, LEAST, TOP = 5, 100, 2000
#: Separators of pieces end up as ``END``, tabs as blanks.
_TABLE = bytearray(ngrams.LOWER)
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = ngrams.END[0]
_TABLE[9] = 32
_TABLE = bytes(_TABLE)


def split(text: bytes) -> list[bytes]:
    """Words and, at the end of each piece, ``END``; a blank is all that parts words."""
    pieces = text.translate(_TABLE).replace(ngrams.END, b" \xff ")
    return [w for w in pieces.split(b" ") if w] + [ngrams.END]


def halves(n: int, b: int) -> tuple[int, int]:
    """Widths of the two halves of ``n`` numbers of ``b`` bits: an odd number's middle word is cut in two."""
    right = (n // 2) * b + (b // 2 if n % 2 else 0)
    if n * b - right > 63:
        raise ValueError(f"{n} words of {b} bits do not fit two halves of 63 bits")
    return n * b - right, right


def pack(ids: list[np.ndarray], b: int) -> tuple[np.ndarray, np.ndarray]:
    n, low = len(ids), b // 2
    left = right = np.zeros(len(ids[0]), np.uint64)
    for i in ids[: n // 2]:
        left = left << np.uint64(b) | i
    if n % 2:
        left = left << np.uint64(b - low) | ids[n // 2] >> np.uint64(low)
        right = ids[n // 2] & np.uint64((1 << low) - 1)
    for i in ids[(n + 1) // 2 :]:
        right = right << np.uint64(b) | i
    return left, right


def unpack(left: np.ndarray, right: np.ndarray, n: int, b: int) -> list[np.ndarray]:
    low, ones, out = b // 2, np.uint64((1 << b) - 1), [None] * n
    for k in range(n - 1, (n + 1) // 2 - 1, -1):
        out[k], right = right & ones, right >> np.uint64(b)
    if n % 2:
        out[n // 2] = (left & np.uint64((1 << (b - low)) - 1)) << np.uint64(low) | right
        left = left >> np.uint64(b - low)
    for k in range(n // 2 - 1, -1, -1):
        out[k], left = left & ones, left >> np.uint64(b)
    return out


_ROUNDS = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]


def _stir(values: np.ndarray, factor: np.uint64, width: int) -> np.ndarray:
    h = (values + factor) * factor
    h = (h ^ (h >> np.uint64(32))) * factor
    return (h ^ (h >> np.uint64(29))) & np.uint64((1 << width) - 1)


def permute(left: np.ndarray, right: np.ndarray, widths: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """A Feistel network: each round changes one half by a function of the other, so it can be undone."""
    for k, factor in enumerate(_ROUNDS):
        if k % 2:
            right = right ^ _stir(left, factor, widths[1])
        else:
            left = left ^ _stir(right, factor, widths[0])
    return left, right


def restore(left: np.ndarray, right: np.ndarray, widths: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    for k, factor in reversed(list(enumerate(_ROUNDS))):
        if k % 2:
            right = right ^ _stir(left, factor, widths[1])
        else:
            left = left ^ _stir(right, factor, widths[0])
    return left, right


def _key(left: np.ndarray, right: np.ndarray, widths: tuple[int, int]) -> tuple[np.ndarray, np.ndarray | None]:
    """One number where both halves fit in it."""
    return (left << np.uint64(widths[1]) | right, None) if sum(widths) <= 63 else (left, right)


def _width(widths: tuple[int, int]) -> int:
    return sum(widths) if sum(widths) <= 63 else widths[0]


def pair_keys(numbers: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs of numbered words, and their permuted keys; number 0 parts what no phrase may cross."""
    at = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
    widths = halves(2, b)
    return at, _key(*permute(*pack([numbers[at], numbers[at + 1]], b), widths), widths)[0]


def filters(numbers: np.ndarray, n: int, b: int, bits: int, base: dict, frequent: np.ndarray | None = None) -> Iterator[dict]:
    """The sorted filter of one shard for n-grams of ``n``.

    ``frequent`` tells for each token whether the pair that begins there reaches the threshold: a longer phrase with
    another pair in it cannot reach it, and is not counted.
    """
    if len(numbers) < n:
        return
    if n == 2:
        at, _ = pair_keys(numbers, b)
    else:
        pairs = (numbers[:-1] > 0) & (numbers[1:] > 0) if frequent is None else frequent
        whole = pairs[: len(numbers) - n + 1].copy()
        for k in range(1, n - 1):
            whole &= pairs[k : len(numbers) - n + 1 + k]
        at = np.flatnonzero(whole)
    if not len(at):
        return
    widths = halves(n, b)
    left, right, counts = ngrams.distinct(*_key(*permute(*pack([numbers[at + k] for k in range(n)], b), widths), widths))
    width = _width(widths)
    yield from ngrams.key_requests(left, right, counts, width, min(bits, width), {**base, "level": n})


def merged(rows: Iterator[dict], n: int, b: int, bits: int, least: int, hold: int = 1 << 21) -> Iterator[tuple[np.ndarray, ...]]:
    """The filters of one slice merged as they come; the numbers and counts of phrases that reach ``least``."""
    widths = halves(n, b)
    width = _width(widths)
    bits, parts, held = min(bits, width), [], 0

    def join():
        right = None if parts[0][1] is None else np.concatenate([p[1] for p in parts])
        return ngrams.distinct(np.concatenate([p[0] for p in parts]), right, np.concatenate([p[2] for p in parts]))

    for row in rows:
        parts.append((*ngrams.keys_of(row, width, bits), ngrams.widen(row["counts"], row["n"]).astype(np.int64)))
        held += row["n"]
        if held >= hold:
            parts = [join()]
            held, hold = 0, max(hold, len(parts[0][0]))
    left, right, counts = join()
    enough = counts >= least
    left, right, counts = left[enough], None if right is None else right[enough], counts[enough]
    if right is None:
        left, right = left >> np.uint64(widths[1]), left & np.uint64((1 << widths[1]) - 1)
    yield (*unpack(*restore(left, right, widths), n, b), counts)


_ANSWER = "grp string, slice int, shard long, n int, extra binary, ranks binary, word string, rank long, count long"
_ANSWER_ARROW = pa.schema([
    ("grp", pa.string()), ("slice", pa.int32()), ("shard", pa.int64()), ("n", pa.int32()), ("extra", pa.binary()), ("ranks", pa.binary()),
    ("word", pa.string()), ("rank", pa.int64()), ("count", pa.int64()),
])
_PHRASE_ARROW = pa.schema([("grp", pa.string()), ("ids", pa.list_(pa.int32())), ("a", pa.int64())])
_PAIRS = "grp string, ids array<int>, a long, shard long, slice int, n_hits int, hits binary"
_PAIR_ARROW = pa.schema([*_PHRASE_ARROW, ("shard", pa.int64()), ("slice", pa.int32()), ("n_hits", pa.int32()), ("hits", pa.binary())])


def count_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shard_tokens: int = ngrams.SHARD_TOKENS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words per language (``grp, n``), numbered words (``grp, id, word``), and all phrases of 1 to ``longest`` words that occur
    ``least`` times or more (``grp, ids, a``), all stored."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("grp"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    shards = stored(ngrams.shard_texts(texts, split, shard_tokens), "phrase-shards")
    bits = ngrams.slice_bits(shards.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in ngrams.rows_of(batches):
            yield from ngrams.word_requests(row, ngrams.widen(row["tokens"], row["n_tokens"]), ngrams.words_of(row), bits)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for (grp, _, k), rows in ngrams.slices_of(batches):
            rows = list(rows)  # one slice: a bounded part of all words
            index, places = ngrams.asked_words(rows)
            total = np.zeros(len(index), np.int64)
            for row, at in zip(rows, places, strict=True):
                total[at] += ngrams.widen(row["counts"], row["n"]).astype(np.int64)
            if ngrams.END in index:
                total[index[ngrams.END]] = 0
            ranks = np.where(total >= least, np.cumsum(total >= least), 0)
            listed = list(index)
            for i in np.flatnonzero(ranks).tolist():
                yield {"grp": grp, "slice": k, "word": listed[i].decode(), "rank": int(ranks[i]), "count": int(total[i])}
            for row, at in zip(rows, places, strict=True):
                own = np.flatnonzero(ranks[at])
                if len(own):  # rarer words stay number 0
                    extra = np.cumsum(ngrams.widen(row["extra"], row["n"]).astype(np.int64))[own]
                    yield {
                        "grp": grp, "slice": k, "shard": row["shard"], "n": len(own), "extra": ngrams.squeeze(np.diff(extra, prepend=0)),
                        "ranks": ngrams.squeeze(ranks[at][own]),
                    }

    requests = shards.mapInArrow(lambda b_: ngrams.batches_of(ask(b_), ngrams.REQUEST_ARROW), ngrams.REQUEST_SCHEMA)
    answers = stored(ngrams.by_slice(requests).mapInArrow(lambda b_: ngrams.batches_of(answer(b_), _ANSWER_ARROW), _ANSWER), "phrase-words")
    words = answers.where("word is not null")
    before = Window.partitionBy("grp").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = words.groupBy("grp", "slice").agg(F.max("rank").alias("size"))  # a row per language and slice
    offsets = stored(sizes.select("grp", "slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"), "size"), "phrase-offsets")
    most = offsets.agg(F.coalesce(F.max(F.col("offset") + F.col("size")), F.lit(0))).first()[0]
    b = max(2, int(most).bit_length())
    numbered = stored(words.join(offsets, ["grp", "slice"]).select("grp", (F.col("offset") + F.col("rank")).cast("int").alias("id"), "word", "count"), "phrase-numbers")

    def numbers_of(row: dict) -> np.ndarray:
        ids = np.zeros(row["n_words"], np.uint64)
        for a in row["answers"]:
            ids[np.cumsum(ngrams.widen(a["extra"], a["n"]).astype(np.int64))] = ngrams.widen(a["ranks"], a["n"]) + np.uint64(a["offset"])
        return ids[ngrams.widen(row["tokens"], row["n_tokens"]).astype(np.int64)]

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for row in ngrams.rows_of(batches):
            yield from filters(numbers_of(row), 2, b, bits, {"grp": row["grp"], "shard": row["shard"], "kind": 0})

    def merge_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = _width(halves(2, b))
        for (grp, _, k), rows in ngrams.slices_of(batches):
            rows = list(rows)  # one slice: a bounded part of all pairs
            for *ids, counts in merged(iter(rows), 2, b, bits, least):
                yield _listed(grp, ids, counts, _PAIR_ARROW)
                enough = np.sort(_key(*permute(*pack([i.astype(np.uint64) for i in ids], b), halves(2, b)), halves(2, b))[0])
            found = []
            for row in rows:
                keys, _ = ngrams.keys_of(row, width, min(bits, width))
                hit = np.isin(keys, enough, assume_unique=True)
                if hit.any():
                    found.append({"shard": row["shard"], "slice": k, "n_hits": int(hit.sum()), "hits": ngrams.squeeze(np.diff(np.flatnonzero(hit), prepend=0))})
            if found:
                yield pa.RecordBatch.from_pylist(found, _PAIR_ARROW)

    def count_longer(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """Phrases of three words and more, where every pair in them is frequent."""
        for row in ngrams.rows_of(batches):
            numbers = numbers_of(row)
            at, keys = pair_keys(numbers, b)
            known, _, _ = ngrams.distinct(keys)
            width = _width(halves(2, b))
            own_bits = min(bits, width)
            starts = np.searchsorted(known >> np.uint64(width - own_bits), np.arange(1 << own_bits, dtype=np.uint64))
            good = np.zeros(len(known) + 1, bool)
            for h in row["hits"]:
                places = np.cumsum(ngrams.widen(h["hits"], h["n_hits"]).astype(np.int64))
                good[starts[h["slice"]] + places] = True
            frequent = np.zeros(max(len(numbers) - 1, 0), bool)
            frequent[at] = good[np.searchsorted(known, keys)]
            for n in range(3, longest + 1):
                yield from filters(numbers, n, b, bits, {"grp": row["grp"], "shard": row["shard"], "kind": 0}, frequent)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (grp, n, _), rows in ngrams.slices_of(batches):
            for *ids, counts in merged(rows, n, b, bits, least):
                yield _listed(grp, ids, counts, _PHRASE_ARROW)

    def asked(run, shards_: DataFrame) -> DataFrame:
        return ngrams.by_slice(shards_.mapInArrow(lambda b_: ngrams.batches_of(run(b_), ngrams.REQUEST_ARROW), ngrams.REQUEST_SCHEMA))

    given = answers.where("shard is not null").join(offsets.select("grp", "slice", "offset"), ["grp", "slice"])
    held = given.groupBy("shard").agg(F.collect_list(F.struct("n", "extra", "ranks", "offset")).alias("answers"))
    known_words = shards.select("shard", "grp", "n_tokens", "n_words", "tokens").join(held, "shard")
    pairs = stored(asked(count_pairs, known_words).mapInArrow(merge_pairs, _PAIRS), "phrase-pairs")
    hits = pairs.where("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("slice", "n_hits", "hits")).alias("hits"))
    longer = asked(count_longer, known_words.join(hits, "shard")).mapInArrow(merge, "grp string, ids array<int>, a long")
    single = numbered.select("grp", F.array("id").alias("ids"), F.col("count").alias("a"))
    phrases = longer.unionByName(pairs.where("shard is null").select("grp", "ids", "a")).unionByName(single)
    return stored(_word_totals(shards), "phrase-totals"), numbered, stored(phrases, "phrases")


def _listed(grp: str, ids: list[np.ndarray], counts: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """Phrases as rows; columns that only answers have are null."""
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * len(ids)), pa.array(np.column_stack(ids).astype(np.int32).ravel()))
    columns = {"grp": pa.array([grp] * len(counts), pa.string()), "ids": lists, "a": pa.array(counts)}
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(counts), f.type)) for f in schema], schema=schema)


def _word_totals(shards: DataFrame) -> DataFrame:
    """Words per language: tokens that are no ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in ngrams.rows_of(batches):
            words = int(np.count_nonzero(ngrams.widen(row["tokens"], row["n_tokens"])))
            yield pa.RecordBatch.from_arrays([pa.array([row["grp"]]), pa.array([words])], names=["grp", "n"])

    return shards.select("grp", "n_tokens", "tokens").mapInArrow(run, "grp string, n long").groupBy("grp").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shard_tokens: int = ngrams.SHARD_TOKENS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases."""
    totals, words, phrases = count_phrases(docs, least, longest, shard_tokens)
    some = phrases.where(F.size("ids") > 1)
    part = lambda name, count: phrases.select("grp", F.col("ids").alias(name), F.col("a").alias(count))
    cuts = some.select("grp", "ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("slice(ids, 1, k)"), "rest": F.expr("slice(ids, k + 1, size(ids) - k)")})
    cuts = cuts.join(part("first", "l"), ["grp", "first"]).join(part("rest", "r"), ["grp", "rest"]).join(totals, "grp")
    wide = lambda c: f"cast({c} as decimal(18,0))"
    score = F.expr(f"cast({wide('a')} * {wide('n')} * 1000 as decimal(38,0)) div ({wide('l')} * {wide('r')})")
    lowest = cuts.groupBy("grp", "ids").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "n")).alias("cut")).select("grp", "ids", "cut.*")
    inner = (
        some.where(F.size("ids") > 2)
        .select("grp", "ids", "a", F.explode(F.sequence(F.lit(2), F.size("ids") - 1)).alias("m"))
        .select("grp", "ids", "a", "m", F.explode(F.expr("sequence(1, size(ids) - m + 1)")).alias("from"))
        .select("grp", F.expr("slice(ids, from, m)").alias("ids"), "a")
        .groupBy("grp", "ids")
        .agg(F.max("a").alias("longer"))
    )
    left = lowest.join(inner, ["grp", "ids"], "left").where(F.coalesce("longer", F.lit(0)) < F.col("a"))
    order = [F.desc("score"), F.desc("a")]
    # Rows that tie at the last place stay until their texts decide.
    first = left.withColumn("place", F.rank().over(Window.partitionBy("grp").orderBy(*order))).where(F.col("place") <= top)
    first = stored(first.drop("place", "longer"), "phrase-first")
    spelled = (
        first.select("grp", "ids", F.posexplode("ids").alias("at", "id"))
        .join(words.select("grp", "id", "word"), ["grp", "id"])
        .groupBy("grp", "ids")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    rank = F.row_number().over(Window.partitionBy("grp").orderBy(*order, "phrase"))
    return (
        first.join(spelled, ["grp", "ids"]).withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
        .select(F.col("grp").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
    )

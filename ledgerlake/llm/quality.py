"""Quality rules: base counts, and how far a text is from its language; column expressions only.

Each whole text gives a histogram of character classes and one of common words. References per language are the sums
of these histograms over all rows of that language that pass the base rules. A text is compared with every reference
by Jensen-Shannon distance (0 to 1) and takes the language whose words are nearest; it is kept if both distances are
small. The languages are those of the table: for four of them the common words are fixed, for any other with ``MIN_ROWS`` rows
they are its most frequent words, counted over all its rows. A row whose own language has no reference is
judged by the base rules alone. Guard: a text below ``MIN_WORDS`` words fails the base rules, as its histograms say too little.

Null and empty texts have zero words and fail; repeated rows get equal results; an empty table gives no rows. Rows
without a known language are judged but add nothing to the references. If no reference can be built, the base rules
decide alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import SPACE, stored

# Frequent short words of each reference language.
COMMON = {
    "en": "the of and to in is that it for was on are as with by be at this from or have an they which not".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se il avec".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más o es".split(),
}
#: Rows a language without fixed words needs to have words and a reference of its own, and how many words it gets.
MIN_ROWS, TOP_WORDS = 50, 30
CLASSES = ["other", "upper", "space", "symbol", "mark"]

MIN_WORDS, MAX_REPEAT = 50, 50
#: Largest distances of a text that is kept.
MAX_CLASS, MAX_WORD = 0.20, 0.305
#: Repeated windows of a text up to which they are looked up one by one.
LOOK_UP = 64


def common_words(docs: DataFrame, min_rows: int = MIN_ROWS, top: int = TOP_WORDS) -> dict[str, list[str]]:
    """Common words by reference language: ``top`` words a language on the driver. Ties go to the first word in byte order."""
    words = {k: list(v) for k, v in COMMON.items()}
    others = docs.where(F.col("lang").isNotNull() & ~F.col("lang").isin(list(COMMON))).groupBy("lang").count()
    counted = [r["lang"] for r in others.where(F.col("count") >= min_rows).collect()]
    if counted:
        each = docs.where(F.col("lang").isin(counted)).select("lang", F.explode(F.split("text", f"{SPACE}+")).alias("w"))
        counts = each.where(F.col("w").rlike(r"^[\p{Ll}\p{Lo}\p{M}]+$")).groupBy("lang", "w").count()
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "w"))
        for r in counts.withColumn("place", place).where(F.col("place") <= top).collect():
            words.setdefault(r["lang"], []).append(r["w"])
    return words


def features(docs: DataFrame, common: dict[str, list[str]] | None = None) -> DataFrame:
    """Base counts, class counts and common-word counts of every row."""
    listed = sorted({w for words in (COMMON if common is None else common).values() for w in words})
    text = F.col("text_")
    has_word = r"[^\x20\x09-\x0D]"
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    blanks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "))) + count(r"[\x09-\x0D]")
    no_hash, no_place = F.expr("filter(array(0L), x -> false)"), F.expr("filter(array(0), x -> false)")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("lang_"), F.coalesce(F.col("text"), F.lit("")).alias("text_"))
    rows = rows.select("*", F.array_remove(F.split(text, f"{SPACE}+"), "").alias("words_"))
    rows = rows.select(
        "doc_id",
        "lang_",
        F.size("words_").cast("long").alias("n_words"),
        F.length(text).cast("long").alias("length_"),
        blanks.cast("long").alias("space_"),
        count("[#*$%&|<>]").alias("n_symbols"),
        count(r"\p{Lu}").alias("upper_"),
        count(r"[.,;:!?'\"()0-9-]").alias("mark_"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(has_word)).alias("lines_"),
        F.filter("words_", lambda w: w.isin(listed)).alias("common_"),
        # 3-word windows as 64-bit hashes
        F.when(
            F.size("words_") >= 3,
            F.transform(F.sequence(F.lit(0), F.size("words_") - 3), lambda i: F.xxhash64(F.get("words_", i), F.get("words_", i + 1), F.get("words_", i + 2))),
        ).otherwise(no_hash).alias("windows_"),
    )
    found = F.transform(F.array_distinct("common_"), lambda w: F.struct(w.alias("w"), F.size(F.filter("common_", lambda x: x == w)).cast("long").alias("n")))
    rows = rows.select(
        "doc_id",
        "lang_",
        "n_words",
        (F.col("length_") - F.col("space_")).alias("word_chars"),
        "n_symbols",
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        F.array(F.col("length_") - F.col("space_") - F.col("upper_") - F.col("n_symbols") - F.col("mark_"), "upper_", "space_", "n_symbols", "mark_").alias("classes_"),
        found.alias("found_"),
        "windows_",
        F.sort_array("windows_").alias("ordered_"),
    )
    rows = rows.withColumn("again_", F.array_distinct(F.filter("ordered_", lambda x, k: x == F.get("ordered_", k - 1)))).drop("ordered_")
    # few repeated windows (nearly all texts): look each window up; many: sort windows with their places
    many = F.size("again_") > LOOK_UP
    rows = rows.withColumn(
        "sorted_",
        F.when(many, F.array_sort(F.transform("windows_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.expr("filter(array(struct(0L as h, 0 as i)), x -> false)")),
    )
    by_sort = F.transform(F.filter("sorted_", lambda x, k: (F.get("sorted_", k - 1)["h"] == x["h"]) | F.coalesce(F.get("sorted_", k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])
    by_look_up = F.filter(F.transform("windows_", lambda h, i: F.when(F.array_contains("again_", h), i).otherwise(-1)), lambda i: i >= 0)
    places = F.when(F.size("again_") == 0, no_place).when(many, by_sort).otherwise(by_look_up)
    covered = F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2))))
    rows = rows.withColumn("n_repeat_words", F.size(covered).cast("long")).drop("sorted_", "again_", "windows_")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def references(rows: DataFrame, languages: list[str]) -> tuple[dict[str, list[int]], dict[str, dict[str, int]]]:
    """Class and word counts per reference language: a row for each and for each of the common words on the driver.

    The word counts have an entry ``""`` for all other words.
    """
    good = rows.where(~F.col("base_failed") & F.col("lang_").isin(languages))
    sums = good.groupBy("lang_").agg(F.sum("n_words").alias("n"), *[F.sum(F.get("classes_", F.lit(k))).alias(c) for k, c in enumerate(CLASSES)]).collect()
    words = good.select("lang_", F.explode("found_").alias("f")).groupBy("lang_", F.col("f.w").alias("w")).agg(F.sum("f.n").alias("n")).collect()
    by_word: dict[str, dict[str, int]] = {r["lang_"]: {"": r["n"]} for r in sums}
    for r in words:
        by_word[r["lang_"]][r["w"]] = r["n"]
        by_word[r["lang_"]][""] -= r["n"]
    return {r["lang_"]: [int(r[c]) for c in CLASSES] for r in sums}, by_word


def _part(p: Column, q: Column) -> Column:
    """One bin's share in the divergence, in bits; ``p`` or ``q`` may be zero."""
    log = lambda x: F.when(x > 0, x * (F.log2(x) - F.log2((p + q) / 2))).otherwise(F.lit(0.0))
    return (log(p) + log(q)) / 2


def class_distance(reference: list[int]) -> Column:
    total = F.greatest(F.col("word_chars") + F.get("classes_", F.lit(CLASSES.index("space"))), F.lit(1))
    whole = max(1, sum(reference))
    parts = [_part(F.get("classes_", F.lit(k)) / total, F.lit(n / whole)) for k, n in enumerate(reference)]
    return F.sqrt(F.greatest(sum(parts, F.lit(0.0)), F.lit(0.0)))


def word_distance(reference: dict[str, int]) -> Column:
    """Over the common words and one bin for all others."""
    whole = max(1, sum(reference.values()))
    share = F.create_map(*[x for w, n in sorted(reference.items()) for x in (F.lit(w), F.lit(n / whole))])
    q = lambda f: F.coalesce(F.element_at(share, f["w"]), F.lit(0.0))
    total = F.greatest("n_words", F.lit(1))
    seen = F.aggregate("found_", F.lit(0.0), lambda a, f: a + _part(f["n"] / total, q(f)))
    unseen = F.lit(1.0 - reference[""] / whole) - F.aggregate("found_", F.lit(0.0), lambda a, f: a + q(f))
    others = _part((F.col("n_words") - F.col("common_n")) / total, F.lit(reference[""] / whole))
    return F.sqrt(F.greatest(seen + unseen / 2 + others, F.lit(0.0)))


def judge(rows: DataFrame, languages: list[str] | None = None, max_class: float = MAX_CLASS, max_word: float = MAX_WORD) -> DataFrame:
    """Base counts, distances to the nearest language and the verdict. ``rows`` should be stored: they are read twice."""
    classes, words = references(rows, list(COMMON) if languages is None else languages)
    rows = rows.withColumn("common_n", F.aggregate("found_", F.lit(0).cast("long"), lambda a, f: a + f["n"]))
    if classes:
        each = F.array(*[F.struct(word_distance(words[k]).alias("by_word"), class_distance(classes[k]).alias("by_class"), F.lit(k).alias("nearest")) for k in sorted(classes)])
        rows = rows.withColumn("best_", F.array_min(each)).select("*", "best_.*")
        near = (F.col("by_class") <= max_class) & (F.col("by_word") <= max_word) | F.col("lang_").isNotNull() & ~F.col("lang_").isin(list(classes))
    else:
        rows = rows.select("*", *[F.lit(None).cast("double").alias(c) for c in ("by_word", "by_class")], F.lit(None).cast("string").alias("nearest"))
        near = F.lit(True)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "by_class", "by_word", "nearest",
    )


def quality(docs: DataFrame) -> DataFrame:
    common = common_words(docs)
    return judge(stored(features(docs, common), "quality"), sorted(common))

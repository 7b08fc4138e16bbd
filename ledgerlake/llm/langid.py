"""Language by compression.

Each language has a raw-content zstandard dictionary made of slices of its learning rows, in lower case. A text is cut into blocks
that are compressed with every dictionary; the language with the smallest sum wins. Blocks keep the dictionary in
reach however long the text is, and the whole text counts. A narrow margin between the two smallest sums marks the
row as rejected (column ``confident``); its best guess is still given. Digits in other forms (``²``, ``Ⅷ``) are no letters.

A null text and one without a letter are ``und`` with score 0. Ties go to the language with more learning rows, then
by name. With no learning rows everything is ``und``. Repeated rows get the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import held_out, thinned

#: Learning rows per language (lowest hash of the id first), characters of the slice taken from each, block bytes.
SAMPLE_ROWS, SLICE, BLOCK = 400, 320, 2048
#: Compression level of every block, so that the last one of a text counts like the others.
LEVEL = 6
#: Bytes by which the best sum must beat the second best, for each 1,000 bytes of text, or the row is rejected.
MARGIN = 4.0
#: Bytes of lead that count as one nat of evidence in the score.
TEMPERATURE = 3.0
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, slice_chars: int = SLICE) -> Model:
    """At most ``sample_rows`` slices per language reach the driver. A slice's place follows from the text's hash."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    learning = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    place = f"cast(1 + pmod(xxhash64(text), greatest(length(text) - {slice_chars}, 1)) as int)"
    common = {r["lang"]: r["count"] for r in learning.groupBy("lang").count().collect()}  # a row per language
    if not common:
        return Model((), ())
    total = F.element_at(F.create_map(*[F.lit(x) for pair in common.items() for x in pair]), F.col("lang"))
    rows = (
        learning.where(thinned(F.col("doc_id"), sample_rows, total) & F.col("text").rlike(r"\p{L}"))
        .withColumn("n", F.row_number().over(order))  # Spark keeps no more than the limit per task before the shuffle
        .where(F.col("n") <= sample_rows)
        .select("lang", "n", F.expr(f"substring(text, {place}, {slice_chars})").alias("part"))
        .collect()
    )
    by: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        by.setdefault(r["lang"], []).append((r["n"], r["part"].lower()))
    names = sorted(by, key=lambda k: (-common[k], k))
    return Model(tuple(names), tuple("\n".join(p for _, p in sorted(by[k])).encode() for k in names))


@lru_cache(maxsize=4)
def _compressors(model: Model, level: int = LEVEL) -> list[zstandard.ZstdCompressor]:
    made = []
    for data in model.dictionaries:
        held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=level)
        made.append(zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False))
    return made


def sizes(model: Model, text: str, block: int = BLOCK) -> np.ndarray:
    """Compressed bytes of the whole text with each dictionary."""
    data = text.lower().encode("utf-8", "surrogatepass")
    total = np.zeros(len(model.languages), np.int64)
    for start in range(0, len(data), block):
        part = data[start : start + block]
        total += [len(c.compress(part)) for c in _compressors(model)]
    return total


def classify(model: Model, text: str | None) -> tuple[str, float, bool]:
    """Language, score and whether the margin is wide enough."""
    if not text or not model.languages or not LETTER.search(text):
        return "und", 0.0, False
    total = sizes(model, text)
    best = int(np.argmin(total))
    odds = np.exp(-np.minimum((total - total[best]) / TEMPERATURE, 60))
    second = np.delete(total, best).min() if len(total) > 1 else 2 * total[best]
    confident = bool((second - total[best]) * 1000 >= MARGIN * len(text))
    return model.languages[best], float(1 / odds.sum()), confident


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, confident`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [classify(model, t.as_py()) for t in batch.column(2)]
            columns = [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[key, "held_out", "lang_pred", "score", "confident"])

    rows = docs.select(F.col(key).cast("long").alias(key), held_out(F.col(key)).alias("held_out"), "text")
    return rows.mapInArrow(run, f"{key} long, held_out boolean, lang_pred string, score double, confident boolean")

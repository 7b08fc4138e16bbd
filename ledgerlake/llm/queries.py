"""One query per operator over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import collocations, exact, interpolation, langid, packing, pieces, pii, quality, simhash, suffixes, toxicity, trie, webtext
from ledgerlake.llm.common import held_out, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, budget=4)


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op4_webtext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract(table(spark, sf_dir, "pages"))


def op5_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality.quality(table(spark, sf_dir, "documents")).select(columns)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), verify=True)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op11_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation.score(interpolation.fit(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_simhash, op3_suffixes, op4_webtext, op5_exact, op6_quality, op7_packing, op8_pieces, op9_language, op10_pii,
        op11_interpolation, op12_collocations, op13_trie, pipeline,
    )
}

ORACLE = {
    "op5_exact": r"""
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        WINDOW w AS (PARTITION BY norm ORDER BY doc_id)
    """,
}

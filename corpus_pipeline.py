"""A training corpus from raw documents: toxic rows out, copies out, personal data masked, sequences packed.

Each stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept, and is written and read again before
the next one. All but the last return the columns of ``docs``. Near duplicates are texts whose fingerprints of four-word
shingles are linked by steps of at most 4 of 64 bits.

A null text is an empty one, and stays null where it stays. Rows are told apart by id and text: a repeated id does no harm, and of rows that
repeat both one stays. Where several rows could stay, the smallest id does, a missing one first of all. Columns beside ``doc_id`` and
``text`` are carried along, whatever their names. An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import exact, packing, pii, simhash, toxicity
from ledgerlake.llm.common import stored, table
from ledgerlake.llm.queries import tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return exact.first_of_groups(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the row with the smallest id."""
    return simhash.first_of_groups(docs, shingle=4, budget=4)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same rows with personal data in the text masked."""
    return pii.redacted(docs, pii.fit(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", near_stage),
    ("pii", pii_stage),
    ("best-fit packing", packing_stage),
]

#: Toxicity, fingerprints, the random field and tokens are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

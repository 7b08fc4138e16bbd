"""Helpers shared by the operators: whole texts, the learning split, results kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+``, as a class for Java and Python patterns.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text only; a null text is an empty one."""
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def held_out(key: Column) -> Column:
    """Rows no model learns from: crc32 of the id as text leaves 1 when divided by 3; a missing id counts too."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(True))


def thinned(key: Column, wanted: int, total: Column | int) -> Column:
    """True for a share of the rows, by hash of the key, that holds about four times the wanted number.

    A bounded sample is then sorted out of this share, not out of all rows, so the task that does it reads little
    however many partitions there are. Small tables keep all rows.
    """
    share = F.least(F.lit(1.0), 4.0 * wanted / F.greatest(F.lit(total) if isinstance(total, int) else total, F.lit(1)))
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < share * float(1 << 30)


def stored(df: DataFrame, purpose: str, partition_by: list[str] | None = None) -> DataFrame:
    """The rows written once below ``spark.checkpoint.dir`` and read again.

    Later jobs start from the files, so a lost executor costs no more than the tasks it ran.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)  # columns to partition by come last

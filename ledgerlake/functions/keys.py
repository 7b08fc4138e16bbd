"""Identifiers: checked UUID text, name-based UUIDs and key guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import ColumnOrName, as_column

# The OID name space of RFC 4122 and the canonical text form.
OID_NAMESPACE = "6ba7b8129dad11d180b400c04fd430c8"
UUID_PATTERN = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ZERO_UUID = "00000000-0000-0000-0000-000000000000"


def uuid_text(c: ColumnOrName, strict: bool = True) -> Column:
    """Lower-cased UUID text. Malformed text raises, or becomes NULL when not strict."""
    low = F.lower(F.trim(as_column(c)))
    if not strict:
        return F.when(low.rlike(UUID_PATTERN), low)
    bad = F.raise_error(F.concat(F.lit("not a UUID: "), low))
    return F.when(low.isNull() | low.rlike(UUID_PATTERN), low).otherwise(bad.cast("string"))


def uuid5_key(*parts: ColumnOrName, namespace: str = OID_NAMESPACE) -> Column:
    """Name-based UUID (version 5) of the parts joined with ``|``; never NULL or empty.

    The digest is the one element of an array: five texts that each name it would each hash the parts again wherever
    the id stands in a branch, where Spark does not share expressions. ``fill_uuid5`` is cheaper for a column of a DataFrame.
    """
    return F.element_at(F.transform(F.array(_digest(parts, namespace)), _uuid5_text), 1)


def fill_uuid5(df: DataFrame, target: str, *parts: ColumnOrName, namespace: str = OID_NAMESPACE) -> DataFrame:
    """The column with its NULL and empty ids replaced by ``uuid5_key`` of the parts, hashed once per such row."""
    own = first_id(target)
    hashed = df.withColumn("_digest", F.when(own.isNull(), _digest(parts, namespace)))
    return hashed.withColumn(target, F.coalesce(own, _uuid5_text(F.col("_digest")))).drop("_digest")


def _digest(parts: Sequence[ColumnOrName], namespace: str) -> Column:
    name = F.concat_ws("|", *[as_column(p).cast("string") for p in parts])
    return F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))


def _uuid5_text(digest: Column) -> Column:
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def first_id(*candidates: ColumnOrName) -> Column:
    """The first id that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(as_column(c).cast("string"), F.lit("")) for c in candidates])


def assert_key(c: ColumnOrName, name: str = "key") -> Column:
    """The key itself; a NULL key raises."""
    c = as_column(c)
    return F.coalesce(c, F.raise_error(F.lit(f"NULL in key column {name}")))

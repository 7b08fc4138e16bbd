"""Text, flag and enum clean-up as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: ColumnOrName) -> Column:
    """Trim spaces; an empty result is NULL."""
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def lower_text(c: ColumnOrName) -> Column:
    return text(F.lower(as_column(c)))


def upper_text(c: ColumnOrName) -> Column:
    return text(F.upper(as_column(c)))


def blank_to_null(c: ColumnOrName) -> Column:
    """NULL for text of white space only (any kind); other text stays untouched."""
    c = as_column(c)
    return F.when(~c.rlike(r"^\s*$"), c)


def flag(condition: Column) -> Column:
    """A two-valued flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def any_of(c: ColumnOrName, *values: str) -> Column:
    """Case-blind membership that is false, never NULL, for a missing value."""
    return flag(F.upper(as_column(c)).isin(*values))


def keep_values(c: ColumnOrName, *values: str) -> Column:
    """The lower-cased value where it is in the list, else NULL."""
    low = F.lower(F.trim(as_column(c)))
    return F.when(low.isin(*values), low)


def rename_values(c: ColumnOrName, names: Mapping[str, str]) -> Column:
    """Map lower-cased values to names; values outside the map become NULL."""
    low = F.lower(F.trim(as_column(c)))
    by_name: dict[str, list[str]] = {}
    for value, name in names.items():
        by_name.setdefault(name, []).append(value)
    out = F.lit(None).cast("string")
    for name, values in by_name.items():
        out = F.when(low.isin(*values), F.lit(name)).otherwise(out)
    return out


def enum_name(c: ColumnOrName) -> Column:
    """An enum that arrives as text or as ``{"nome": …}``: the name either way."""
    c = as_column(c)
    return F.when(F.ltrim(c).startswith("{"), F.coalesce(F.get_json_object(c, "$.nome"), c)).otherwise(c)


def drop_falsy_json(c: ColumnOrName) -> Column:
    """JSON text of an empty or zero value is NULL."""
    c = as_column(c)
    bare = F.regexp_replace(c, r"\s+", "")
    return F.when(~bare.isin("", "{}", "[]", "null", "false", "0", '""'), c)


def zero_to_null(c: ColumnOrName, zero: object = 0) -> Column:
    return F.nullif(as_column(c), F.lit(zero))


def iso_second(c: ColumnOrName) -> Column:
    """ISO text without fraction and without zone suffix (``Z``, ``+hh:mm``, ``-hh:mm``)."""
    return F.regexp_replace(as_column(c), r"(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$", "")

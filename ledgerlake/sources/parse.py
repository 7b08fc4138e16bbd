"""From JSON item texts to typed raw rows, with the whole item kept beside them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import blank_to_null, drop_falsy_json, enum_name, first_id, uuid_text, zero_to_null
from ledgerlake.functions.keys import ZERO_UUID
from ledgerlake.functions.time import instant
from ledgerlake.sources.entities import KINDS, Entity, Field


def _given(f: Field, parsed: str) -> Column:
    """The field under its own name or the first alias that has a value."""
    return F.coalesce(*[F.col(f"{parsed}.{name}") for name in (f.name, *f.aliases)])


def _typed(f: Field, value: Column) -> Column:
    if f.kind == "uuid":
        return uuid_text(value, strict=False)  # blank text is no UUID
    if f.kind in ("clean", "enum"):
        return blank_to_null(enum_name(value) if f.kind == "enum" else value)
    if f.kind == "ts":
        return F.try_to_timestamp(blank_to_null(value))
    if f.kind == "date":
        return F.try_to_timestamp(blank_to_null(value)).cast("date")
    if f.kind == "bag":
        return drop_falsy_json(value)
    if f.kind in ("names", "refs", "addresses", "subitems"):
        return F.when(F.size(value) > 0, value)
    return value


def parse_entity(
    df: DataFrame, entity: Entity, loaded_at: datetime, item: str = "item", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed columns of the entity, the item itself as ``raw``, and ``_problem`` for unusable items.

    A column of ``df`` named like a field is the parent's value: it fills the field where the item has
    none, or replaces it if the entity says the parent wins. Fields the declaration does not know stay
    in ``raw``. A problem is text that is not JSON of the
    declared types, a missing required field, or a malformed id or time.
    """
    schema = f"{entity.parsed_schema}, _broken string"
    record = F.from_json(item, schema, {"columnNameOfCorruptRecord": "_broken"})
    # A generator keeps later filters above the parse; pushed below it they would parse once per field.
    parsed = df.select("*", F.explode(F.array(record)).alias("_p"))
    problems: list[Column] = [F.when(F.col("_p._broken").isNotNull(), F.lit("not readable as declared"))]
    typed: dict[str, Column] = {}
    parents = {f.name: f"_parent_{f.name}" for f in entity.fields if f.name in df.columns}
    parsed = parsed.withColumnsRenamed(parents)
    for f in entity.fields:
        value = _given(f, "_p")
        if f.name in parents:
            parent = F.col(parents[f.name]).cast(KINDS[f.kind][0])
            wins = f.name in entity.options.get("parent_wins", ())
            value = F.coalesce(parent, value) if wins else F.coalesce(value, parent)
        typed[f.name] = _typed(f, value)
        empty = F.col(f.name).isNull()
        if f.kind in ("uuid", "ts", "date"):
            lost = empty & blank_to_null(value).isNotNull()
            problems.append(F.when(lost, F.lit(f"malformed {f.name}")))
        if f.required:
            empty = empty | (F.length(f.name) == 0) if f.kind == "text" else empty
            problems.append(F.when(empty, F.lit(f"missing {f.name}")))
    columns: dict[str, Column] = {name: F.col(name) for name in typed}
    for name in entity.options.get("zero_is_null", ()):
        zero = 0 if next(f.kind for f in entity.fields if f.name == name) == "long" else ZERO_UUID
        columns[name] = zero_to_null(columns[name], zero)
    for name, path in entity.options.get("ids", {}).items():
        columns[name] = first_id(columns[name], uuid_text(F.col(f"_p.{path}"), strict=False))
    if entity.options.get("singleton"):
        columns = {entity.options["singleton"]: F.lit(1), **columns}
    if entity.keep_raw:
        columns["raw"] = F.col(item)
    columns["loaded_at"] = instant(loaded_at)
    kept = [k for k in keep if k not in columns]
    # Values first, problems from the values: one expression of both would check every id and time twice.
    values = parsed.select(*dict.fromkeys([*kept, item, "_p", *parents.values()]), *[c.alias(name) for name, c in typed.items()])
    return values.select(
        *kept,
        *[c.alias(name) for name, c in columns.items()],
        F.coalesce(*problems).alias("_problem"),
    )


def split_valid(parsed: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame | None]:
    """Usable rows and, in quarantine mode, the rest with its reason; fail mode raises on the first one."""
    if mode == "fail":
        checked = F.when(F.col("_problem").isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("unusable item: "), "_problem")).cast("boolean")
        )
        return parsed.where(checked).drop("_problem"), None
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    return parsed.where(F.col("_problem").isNull()).drop("_problem"), parsed.where(F.col("_problem").isNotNull())

"""Data-quality checks: every column rule of a table in one aggregate pass, one pass per unique key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    severity: str = "error"
    values: tuple = ()
    where: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.column}"


def not_null(column: str, severity: str = "error", where: str | None = None) -> Check:
    return Check("not_null", column, severity, where=where)


def unique(column: str, severity: str = "error", where: str | None = None) -> Check:
    return Check("unique", column, severity, where=where)


def accepted(
    column: str, values: Sequence[object], severity: str = "error", where: str | None = None
) -> Check:
    """Only listed values; NULL is not judged (add ``not_null`` for that)."""
    return Check("accepted_values", column, severity, tuple(values), where)


def singleton(column: str, value: object = 1, severity: str = "error") -> Check:
    """Every row carries one fixed key value."""
    return Check("singleton", column, severity, (value,))


def _broken(check: Check) -> Column:
    column = F.col(check.column)
    if check.kind == "not_null":
        bad = column.isNull()
    elif check.kind == "accepted_values":
        bad = ~column.isin(*check.values)
    elif check.kind == "singleton":
        bad = ~column.eqNullSafe(F.lit(check.values[0]))
    else:
        raise ValueError(f"unknown check {check.kind!r}")
    return bad & F.expr(check.where) if check.where else bad


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``table_name, check_name, column_name, severity, failures, status``.

    ``failures`` counts broken rows; for ``unique`` the values that occur more than once. Keys are
    counted with map-side partial counts, so one very frequent value costs a row per task.
    """
    rows = [c for c in checks if c.kind != "unique"]
    parts = []
    if rows:
        counts = df.agg(*[F.count_if(_broken(c)).alias(f"c{i}") for i, c in enumerate(rows)])
        listed = F.array(*[_line(c, F.col(f"c{i}")) for i, c in enumerate(rows)])
        parts.append(counts.select(F.inline(listed)))
    for check in checks:
        if check.kind == "unique":
            scoped = df.where(check.where) if check.where else df
            repeated = (
                scoped.where(F.col(check.column).isNotNull())
                .groupBy(check.column)
                .agg(F.count(F.lit(1)).alias("n"))
                .where("n > 1")
                .agg(F.count(F.lit(1)).alias("failures"))
            )
            parts.append(repeated.select(F.inline(F.array(_line(check, F.col("failures"))))))
    if not parts:
        raise ValueError("no checks given")
    result = reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "warn", "warn").otherwise("fail")
    )
    return result.select(F.lit(table).alias("table_name"), "*", status.alias("status"))


def _line(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )

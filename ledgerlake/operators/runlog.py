"""Run log: one row per task of a run, and the roll-up of a run from its tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RUN_LOG_KEYS = ("external_run_id",)
# Scheduler trigger kinds by log value.
TRIGGER_KINDS = {
    "scheduled": "scheduled",
    "manual": "manual",
    "backfill": "backfill",
    "backfill_job": "backfill",
    "asset_triggered": "asset",
    "dataset_triggered": "asset",
}
# Who is named when nobody is, by hand and on schedule.
BY_HAND, ON_SCHEDULE = "airflow-ui", "airflow-scheduler"


def trigger_kind(column: str) -> Column:
    out: Column = F.lit("other")
    for given, kind in TRIGGER_KINDS.items():
        out = F.when(F.col(column) == given, F.lit(kind)).otherwise(out)
    return out


def triggered_by(kind: str, who: str) -> Column:
    """Who started the run: the user (or the web page) by hand, the scheduler on schedule."""
    return F.when(F.col(kind) == "manual", F.coalesce(F.nullif(F.col(who), F.lit("")), F.lit(BY_HAND))).when(
        F.col(kind) == "scheduled", F.lit(ON_SCHEDULE)
    )


def task_log(tasks: DataFrame, error_length: int | None = None) -> DataFrame:
    """Log rows keyed on run, task and the index of a mapped task (negative: not mapped).

    Input: ``run_id, task_id, map_index, status, started_at, finished_at, rows_inserted, rows_updated,
    rows_deleted, error``. The error text is kept whole unless ``error_length`` is given.
    """
    suffix = F.when(F.col("map_index") >= 0, F.format_string("[%d]", F.col("map_index"))).otherwise(F.lit(""))
    return tasks.select(
        F.concat("run_id", F.lit("::"), "task_id", suffix).alias("external_run_id"),
        "run_id",
        "task_id",
        "map_index",
        "status",
        "started_at",
        F.when(F.col("status") != "running", F.col("finished_at")).alias("finished_at"),
        "rows_inserted",
        "rows_updated",
        "rows_deleted",
        F.when(F.col("status") == "failed", F.left("error", F.lit(error_length)) if error_length else F.col("error")).alias("error_message"),
    )


def run_rollup(log: DataFrame) -> DataFrame:
    """First start, last finish, row totals and overall status per run.

    A run with both failed and other finished tasks is ``partial_failed``. All measures combine
    map-side, so a run with very many tasks needs no special care.
    """
    failed = F.count_if(F.col("status") == "failed")
    running = F.count_if(F.col("status") == "running")
    total = F.count(F.lit(1))
    status = (
        F.when(failed == total, "failed")
        .when(failed > 0, "partial_failed")
        .when(running > 0, "running")
        .otherwise("success")
    )
    return log.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("finished_at").alias("finished_at"),
        total.alias("tasks"),
        failed.alias("tasks_failed"),
        *[
            F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c)
            for c in ("rows_inserted", "rows_updated", "rows_deleted")
        ],
        status.alias("status"),
    )


def counted(df: DataFrame, name: str, *extra: Column) -> tuple[DataFrame, Observation]:
    """The DataFrame with a row count (and further aggregates) taken while it is written."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen

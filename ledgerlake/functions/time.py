"""Instants given by the caller."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(moment: datetime | str) -> Column:
    """A timestamp literal. Without an offset it is wall-clock time in the session's zone.

    Going through text keeps the driver machine's own time zone out of it.
    """
    text = moment.isoformat(sep=" ") if isinstance(moment, datetime) else moment
    return F.lit(text).cast("timestamp")

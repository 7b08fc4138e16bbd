"""Line items and balance snapshots that arrive without ids of their own."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import first_id, uuid5_key
from ledgerlake.functions.time import instant


def line_number(position: Column, *candidates: str) -> Column:
    """The first line number that is neither NULL nor zero, else the 1-based position."""
    given = [F.nullif(F.col(c).cast("int"), F.lit(0)) for c in candidates]
    return F.coalesce(*given, (position + 1).cast("int"))


def explode_lines(
    df: DataFrame, items: str, keep: Sequence[str], numbers: Sequence[str] = ("numero_item",)
) -> DataFrame:
    """One row per item of an array of structs, with the kept parent columns and ``numero_item``."""
    out = df.select(*keep, F.posexplode(items).alias("_pos", "_item"))
    number = line_number(F.col("_pos"), *[f"_item.{n}" for n in numbers])
    own = df.schema[items].dataType.elementType.names
    rest = [F.col(f"_item.{n}").alias(n) for n in own if n not in (*keep, *numbers)]
    return out.select(*keep, number.alias("numero_item"), *rest)


def sale_item_parts(sale: str, number: str, code: str) -> tuple[Column, ...]:
    return F.lit("venda_item"), F.col(sale), F.coalesce(F.col(number), F.lit(0)), F.coalesce(F.col(code), F.lit(""))


def sale_item_id(own: str, sale: str, number: str, code: str) -> Column:
    return F.coalesce(first_id(own), uuid5_key(*sale_item_parts(sale, number, code)))


def invoice_item_parts(access_key: str, number: str) -> tuple[Column, ...]:
    return F.lit("nf_item"), F.col(access_key), F.col(number)


def invoice_item_id(own: str, access_key: str, number: str) -> Column:
    return F.coalesce(first_id(own), uuid5_key(*invoice_item_parts(access_key, number)))


def opening_balance_parts(account: str, reference: str) -> tuple[Column, ...]:
    """Account and reference time; absent parts count as ``null``."""
    when = F.date_format(reference, "yyyy-MM-dd HH:mm:ss")
    return F.lit("saldo_inicial"), F.coalesce(F.col(account), F.lit("null")), F.coalesce(when, F.lit("null"))


def opening_balance_id(own: str, account: str, reference: str) -> Column:
    """Own id, else one made of account and reference time."""
    return F.coalesce(first_id(own), uuid5_key(*opening_balance_parts(account, reference)))


def daily_snapshot(accounts: DataFrame, balances: DataFrame, now: datetime) -> DataFrame:
    """Today's balance per active account, keyed so that a second run on one day overwrites the first.

    ``accounts`` has ``id`` and ``ativo``; ``balances`` has ``conta_financeira_id``, ``saldo_atual``
    and ``saldo``. An account without a flag counts as active.
    """
    active = accounts.where(F.coalesce("ativo", F.lit(True))).select(F.col("id").alias("conta_financeira_id"))
    moment = now.replace(microsecond=0)
    return balances.join(active, "conta_financeira_id", "left_semi").select(
        uuid5_key(F.lit("saldo_atual"), "conta_financeira_id", F.lit(moment.date().isoformat())).alias("id"),
        "conta_financeira_id",
        "saldo_atual",
        "saldo",
        F.lit(moment.date()).alias("snapshot_date"),
        instant(moment).alias("data_snapshot"),
    )

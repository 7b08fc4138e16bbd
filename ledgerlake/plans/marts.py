"""Delivery marts: small reporting tables over facts and dimensions.

Every mart is one hash aggregation with map-side partial sums, so a hot day or category is combined
before the shuffle. Amounts stay ``decimal(18,4)`` until the final cast.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.time import instant

MONEY = "decimal(14,2)"


def _total(column: Column | str, name: str) -> Column:
    return F.sum(column).cast(MONEY).alias(name)


def _count(name: str) -> Column:
    return F.count(F.lit(1)).cast("int").alias(name)


def clientes_resumo(people: DataFrame, as_of: datetime) -> DataFrame:
    """Customers per kind, with how many can be reached and identified."""
    kind = F.coalesce("tipo_pessoa", F.lit("desconhecido")).alias("tipo_pessoa")
    return people.groupBy(kind).agg(
        F.count(F.lit(1)).alias("total_clientes"),
        F.count_if("has_email").alias("com_email"),
        F.count_if("has_phone").alias("com_telefone"),
        F.count_if("has_documento").alias("com_documento"),
        F.count_if(F.coalesce("documento_is_valid", F.lit(False))).alias("com_documento_valido"),
        instant(as_of).alias("snapshot_at"),
    )


def _daily_titles(titles: DataFrame, total: str, paid: str, by: Sequence[str]) -> DataFrame:
    open_titles = titles.where(F.col("data_competencia").isNotNull() & ~F.col("is_cancelado"))
    days = open_titles.groupBy(*by, F.col("data_competencia").cast("date").alias("dia")).agg(
        _count("qtd"),
        _total("valor_total", total),
        _total("valor_pago", paid),
        _total("valor_nao_pago", "em_aberto"),
    )
    return days if by else days.orderBy("dia")


def fin_receita_diaria(receivables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue per accrual day; cancelled titles are left out.

    With ``by`` (a tenant, say) the days are counted per its values, in one aggregation and without a sort.
    """
    return _daily_titles(receivables, "faturamento", "recebido", by)


def fin_despesa_diaria(payables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Expense per accrual day; cancelled titles are left out. ``by`` as in ``fin_receita_diaria``."""
    return _daily_titles(payables, "total", "pago", by)


def vendas_diaria(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales per day and item kind. ``by`` as in ``fin_receita_diaria``."""
    kept = sales.where(F.col("data_venda").isNotNull() & ~F.coalesce("is_cancelada", F.lit(False)))
    days = kept.groupBy(
        *by,
        F.col("data_venda").cast("date").alias("dia"),
        F.coalesce("tipo_item", F.lit("OUTRO")).alias("tipo_item"),
    ).agg(_count("qtd"), _total("valor_total", "valor_total"))
    return days if by else days.orderBy("dia", "tipo_item")


def saldo_inicial(balances: DataFrame) -> DataFrame:
    """Signed opening balance over all accounts: always one row, zero without input."""
    total = F.coalesce(F.sum("saldo_inicial_liquido"), F.lit(0))
    return balances.agg(total.cast(MONEY).alias("saldo_inicial"))

"""The income statement: its four-level tree and its signed daily values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import uuid_text
from ledgerlake.functions.keys import ZERO_UUID

# Fixed value: the label of leaves whose category has no known parent.
NO_PARENT = "(Sem categoria pai)"


def dre_valores(receivables: DataFrame, payables: DataFrame) -> DataFrame:
    """Signed amount per regime, category and day.

    Receivables count plus, payables minus. Each title is turned into its accrual and its due-date row
    by one ``stack`` over a single scan, then summed with map-side partial aggregation.
    """
    columns = ("categoria_id", "data_competencia", "data_vencimento")

    def signed(titles: DataFrame, sign: int) -> DataFrame:
        kept = titles.where(F.col("categoria_id").isNotNull() & ~F.col("is_cancelado"))
        return kept.select(*columns, (F.col("valor_total") * F.lit(sign)).cast("decimal(18,4)").alias("v"))

    both = signed(receivables, 1).unionByName(signed(payables, -1))
    per_regime = both.select(
        "categoria_id",
        "v",
        F.expr(
            "stack(2, 'competencia', cast(data_competencia as date), 'vencimento', "
            "cast(data_vencimento as date)) as (regime, dia)"
        ),
    )
    return (
        per_regime.where(F.col("dia").isNotNull())
        .groupBy("regime", "categoria_id", "dia")
        .agg(F.sum("v").cast("decimal(14,2)").alias("valor"))
        .orderBy("regime", "categoria_id", "dia")
    )


NODE = (
    "struct<nivel:int,tipo:string,ord_n2:int,ord_n4:int,descricao:string,codigo:string,categoria_id:string>"
)


def _node(level: int, kind: str | Column, n2: Column, n4: Column, *texts: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(F.lit(level), kind, n2, n4, *texts).cast(NODE)


def _own_nodes() -> Column:
    """The nodes one root record spells out: itself, its subgroups and their categories."""
    zero, none = F.lit(0), F.lit(None).cast("string")
    head = F.array(
        _node(
            1,
            F.when(F.col("indica_totalizador"), "totalizador").otherwise("grupo"),
            zero,
            zero,
            F.col("descricao"),
            F.col("codigo"),
            none,
        )
    )

    def subgroup(s: Column, i: Column) -> Column:
        own = F.array(_node(2, "subgrupo", i + 1, zero, s["descricao"], s["codigo"], none))
        leaves = F.transform(
            s["categorias_financeiras"],
            lambda c, j: _node(4, "categoria", i + 1, j + 1, c["nome"], none, c["id"]),
        )
        return F.concat(own, F.coalesce(leaves, F.array().cast(f"array<{NODE}>")))

    below = F.when(~F.col("indica_totalizador"), F.flatten(F.transform("subitens", subgroup)))
    return F.concat(head, F.coalesce(below, F.array().cast(f"array<{NODE}>")))


def dre_estrutura(
    roots: DataFrame,
    categories: DataFrame,
    by: Sequence[str] = (),
    collation: str | None = None,
) -> DataFrame:
    """Flatten the statement tree to ordered rows: group, subgroup, parent category, category.

    ``roots`` is the raw statement table with its nested ``subitens``; ``categories`` the category
    dimension. ``by`` names the columns (a tenant, say) that separate independent trees. Roots with an
    unknown totalizer flag take part in the numbering and nothing else. ``collation`` orders parent
    names by a language's rules instead of by bytes.

    Roots are unfolded in one pass. The ranking windows hold the categories of one subgroup, which came
    in one array of one record; the numbering windows hold one tree, which is one chart of accounts.
    """
    by = list(by)
    last = Column.asc_nulls_last
    root_order = Window.partitionBy(*by).orderBy(
        *[last(F.col(c)) for c in ("posicao", "indica_totalizador", "descricao")]
    )
    own = (
        roots.withColumn("ord_n1", F.row_number().over(root_order))
        .where(F.col("indica_totalizador").isNotNull())
        .select(*by, "ord_n1", F.inline(_own_nodes()))
        .withColumn("categoria_id", uuid_text("categoria_id"))
    )
    leaf_of = categories.select(*by, "categoria_id", "categoria_pai_id")
    parent_of = categories.select(
        *by, F.col("categoria_id").alias("categoria_pai_id"), F.col("categoria_nome").alias("pai_nome")
    )
    placed = (
        own.join(leaf_of, [*by, "categoria_id"], "left")
        .join(parent_of, [*by, "categoria_pai_id"], "left")
        .withColumn("pai_key", F.coalesce("categoria_pai_id", F.lit(ZERO_UUID)))
        .withColumn("pai_nome", F.coalesce("pai_nome", F.lit(NO_PARENT)))
    )

    sort_name = F.collate("pai_nome", collation) if collation else F.col("pai_nome")
    subgroup = [*by, "ord_n1", "ord_n2", "nivel"]
    is_leaf = F.col("nivel") == 4
    rank = F.dense_rank().over(Window.partitionBy(*subgroup).orderBy(last(sort_name)))
    nth = F.row_number().over(Window.partitionBy(*subgroup, "pai_key").orderBy("ord_n4"))
    ranked = placed.select(
        "*", F.when(is_leaf, rank).otherwise(0).alias("ord_n3"), (is_leaf & (nth == 1)).alias("_first")
    )

    # The first category of a parent also stands for the parent's own row.
    shown = ("ord_n1", "ord_n2", "ord_n3", "ord_n4", "nivel", "tipo", "descricao", "codigo", "categoria_id")
    none = F.lit(None).cast("string")
    as_parent = {
        "ord_n4": F.lit(0),
        "nivel": F.lit(3),
        "tipo": F.lit("categoria_pai"),
        "descricao": F.col("pai_nome"),
        "codigo": none,
        "categoria_id": none,
    }
    itself = F.struct(*[F.col(c).alias(c) for c in shown])
    parent = F.struct(*[as_parent.get(c, F.col(c)).alias(c) for c in shown])
    every = ranked.select(
        *by, F.inline(F.when(F.col("_first"), F.array(parent, itself)).otherwise(F.array(itself)))
    )
    display = Window.partitionBy(*by).orderBy("ord_n1", "ord_n2", "ord_n3", "nivel", "ord_n4")
    return every.select(
        *by, F.row_number().over(display).cast("bigint").alias("seq"), *shown
    ).orderBy(*by, "seq")

"""Edge cases of the models on small hand-made rows."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import dims, facts, marts, staging, statement

AS_OF = datetime(2024, 6, 1)
A, B, C, D = (f"0000000{i}-0000-4000-8000-000000000000" for i in range(1, 5))
TITLE = (
    "id string, status string, status_traduzido string, total decimal(18,4), nao_pago decimal(18,4), "
    "pago decimal(18,4), descricao string, data_vencimento timestamp, data_competencia timestamp, "
    "data_criacao timestamp, data_alteracao timestamp, categorias array<struct<id:string,nome:string>>, "
    "centros_de_custo array<struct<id:string,nome:string>>, cliente struct<id:string,nome:string,email:string>, "
    "renegociacao string, raw string, loaded_at timestamp"
)


def title(status="PENDING", due=None, accrual=None, categories=((A, "a"),), client=(B, "n", None), total=10):
    amount = Decimal(total)
    return (
        A, status, " ", amount, amount, Decimal(0), " ", due, accrual, None, None,
        None if categories is None else list(categories), None, client, None, None, AS_OF,
    )


def fact(spark, *rows):
    raw = spark.createDataFrame(list(rows), TITLE)
    return facts.fct_contas_a_receber(staging.stg_contas_a_receber(raw, AS_OF), AS_OF)


def test_title_flags(spark):
    past, future = datetime(2024, 5, 31), datetime(2024, 6, 2)
    rows = [
        title("pending", past), title("PENDING", AS_OF), title("PENDING", future), title("PENDING", None),
        title("ACQUITTED", past), title("Canceled", past), title(None, past), title(" ", past),
    ]
    got = [tuple(r) for r in fact(spark, *rows).select("is_pendente", "is_atrasado", "is_cancelado").collect()]
    assert got == [
        (True, True, False), (True, False, False), (True, False, False), (True, False, False),
        (False, False, False), (False, False, True), (False, True, False), (False, True, False),
    ]


def test_title_categories_and_client(spark):
    rows = [title(categories=None), title(categories=[]), title(categories=((C, "c"), (D, "d"))), title(client=("", " ", None)), title(client=None)]
    got = fact(spark, *rows).select("categoria_id", "num_categorias", "has_cliente", "foi_renegociado").collect()
    assert [tuple(r) for r in got] == [
        (None, 0, True, False), (None, 0, True, False), (C, 2, True, False), (A, 1, False, False), (A, 1, False, False),
    ]
    with pytest.raises(Exception, match="not a UUID"):
        fact(spark, title(client=("x", "y", None))).select("cliente_id").collect()


def test_days_late_cut_toward_zero(spark):
    due = datetime(2024, 5, 10)
    paid = [datetime(2024, 5, 9, 19), datetime(2024, 5, 8, 19), datetime(2024, 5, 12, 1), None]
    stg = spark.createDataFrame([(due, p, "x") for p in paid], "data_vencimento timestamp, data_pagamento timestamp, status string")
    for name in (
        "parcela_id evento_financeiro_id forma_pagamento conta_financeira_id conta_financeira_nome numero_parcela "
        "valor_parcela valor_bruto valor_liquido valor_desconto valor_juros valor_multa source_created_at source_updated_at"
    ).split():
        stg = stg.withColumn(name, F.lit(None).cast("string"))
    got = [r[0] for r in facts.fct_parcelas(stg, AS_OF).select("dias_atraso_pagamento").collect()]
    assert got == [0, -1, 2, None]


def test_contract_expiry_is_three_valued(spark):
    stg = spark.createDataFrame(
        [("a", datetime(2024, 5, 1)), ("b", datetime(2024, 7, 1)), ("c", None)], "contrato_id string, data_fim timestamp"
    )
    for name in "contrato_numero descricao cliente_id valor data_inicio status source_created_at source_updated_at".split():
        stg = stg.withColumn(name, F.lit(None).cast("string"))
    detail = spark.createDataFrame([("a",)], "contrato_id string")
    for name in "vendedor_id vendedor_nome composicao_de_valor condicao_pagamento configuracao_recorrencia termos data_emissao valor_bruto valor_liquido".split():
        detail = detail.withColumn(name, F.lit("1"))
    got = {r["contrato_id"]: (r["is_vencido"], r["has_detalhe"]) for r in dims.dim_contratos(stg, detail, AS_OF).collect()}
    assert got == {"a": (True, True), "b": (False, False), "c": (None, False)}


def test_opening_balance_is_one_row_without_input(spark):
    empty = spark.createDataFrame([], "saldo_inicial_liquido decimal(18,4)")
    assert [tuple(r) for r in marts.saldo_inicial(empty).collect()] == [(Decimal("0.00"),)]


def test_statement_values_signs_and_regimes(spark):
    day, due = datetime(2024, 5, 1, 23), datetime(2024, 5, 31)
    plus = fact(spark, title("PENDING", due, day, total=10), title("CANCELED", due, day, total=99), title("PENDING", None, day, total=5))
    minus = plus.where("valor_total = 5")
    got = [tuple(r) for r in statement.dre_valores(plus, minus).collect()]
    assert got == [
        ("competencia", A, day.date(), Decimal("10.00")),
        ("vencimento", A, due.date(), Decimal("10.00")),
    ]


CATEGORIES = "categoria_id string, categoria_nome string, categoria_pai_id string"
ROOTS = (
    "descricao string, codigo string, posicao int, indica_totalizador boolean, "
    "subitens array<struct<descricao:string,codigo:string,categorias_financeiras:array<struct<id:string,nome:string>>>>"
)


def tree(spark, roots, categories, **options):
    df = statement.dre_estrutura(
        spark.createDataFrame(roots, ROOTS), spark.createDataFrame(categories, CATEGORIES), **options
    )
    return [tuple(r) for r in df.drop("codigo").collect()]


def test_statement_tree_order_and_levels(spark):
    roots = [
        ("late", None, None, False, None),
        ("total", "T", 2, True, [("never", None, [(A, "never")])]),
        ("unknown", None, 1, None, [("never", None, None)]),
        ("group", "G", 3, False, [("empty", None, None), ("sub", "S", [(A, "leaf a"), (B, "leaf b"), (C, "leaf c"), (D, "leaf d")])]),
    ]
    same = "0000000a-0000-4000-8000-000000000000"
    other = "0000000b-0000-4000-8000-000000000000"
    missing = "0000000c-0000-4000-8000-000000000000"
    categories = [(A, "a", same), (B, "b", other), (C, "c", None), (D, "d", missing), (same, "Zeta", None), (other, "Zeta", None)]
    got = tree(spark, roots, categories)
    assert [r[0] for r in got] == list(range(1, len(got) + 1))
    assert [(r[1:5], r[5], r[6], r[7]) for r in got] == [
        ((2, 0, 0, 0), 1, "totalizador", "total"),
        ((3, 0, 0, 0), 1, "grupo", "group"),
        ((3, 1, 0, 0), 2, "subgrupo", "empty"),
        ((3, 2, 0, 0), 2, "subgrupo", "sub"),
        ((3, 2, 1, 0), 3, "categoria_pai", "(Sem categoria pai)"),
        ((3, 2, 1, 0), 3, "categoria_pai", "(Sem categoria pai)"),
        ((3, 2, 1, 3), 4, "categoria", "leaf c"),
        ((3, 2, 1, 4), 4, "categoria", "leaf d"),
        ((3, 2, 2, 0), 3, "categoria_pai", "Zeta"),
        ((3, 2, 2, 0), 3, "categoria_pai", "Zeta"),
        ((3, 2, 2, 1), 4, "categoria", "leaf a"),
        ((3, 2, 2, 2), 4, "categoria", "leaf b"),
        ((4, 0, 0, 0), 1, "grupo", "late"),
    ]


def test_statement_tree_collation_and_separate_trees(spark):
    roots = [("g", None, 1, False, [("s", None, [(A, "x"), (B, "y")])])]
    e_acute, f = "0000000e-0000-4000-8000-000000000000", "0000000f-0000-4000-8000-000000000000"
    categories = [(A, "a", f), (B, "b", e_acute), (f, "f", None), (e_acute, "é", None)]
    names = lambda rows: [r[7] for r in rows if r[5] == 3]
    assert names(tree(spark, roots, categories)) == ["f", "é"]
    assert names(tree(spark, roots, categories, collation="UNICODE")) == ["é", "f"]
    two = lambda df: df.withColumn("tenant", F.explode(F.array(F.lit("t1"), F.lit("t2"))))
    both = statement.dre_estrutura(
        two(spark.createDataFrame(roots, ROOTS)), two(spark.createDataFrame(categories, CATEGORIES)), by=["tenant"]
    )
    assert [(r["tenant"], r["seq"]) for r in both.collect()] == [(t, i) for t in ("t1", "t2") for i in range(1, 7)]


def test_leaf_flags(spark):
    stg = spark.createDataFrame([(A, None), (B, A), (C, A), (D, "gone")], "categoria_id string, categoria_pai_id string")
    for name in "categoria_nome tipo entrada_dre considera_custo_dre versao".split():
        stg = stg.withColumn(name, F.lit("x"))
    got = {r["categoria_id"]: (r["is_raiz"], r["is_folha"]) for r in dims.dim_categorias_financeiras(stg, AS_OF).collect()}
    assert got == {A: (True, False), B: (False, True), C: (False, True), D: (False, True)}

"""Facts: one row per business event, with status flags and derived amounts.

All facts are narrow projections of one staged table: no join, no shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import any_of, flag
from ledgerlake.functions.time import instant

# Status words of the source system, in both of its languages where it has two.
ISSUED = ("EMITIDA", "CORRIGIDA_SUCESSO")
FAILED = ("FALHA", "FALHA_CANCELAMENTO")
IN_PROGRESS = ("PENDENTE", "PRONTA_ENVIO", "AGUARDANDO_RETORNO", "EM_ESPERA", "EMITINDO")
INSTALMENT_PAID = ("PAGO", "QUITADO", "ACQUITTED")
INSTALMENT_OPEN = ("ABERTO", "PENDING", "PENDENTE")
INSTALMENT_CANCELLED = ("CANCELADO", "CANCELED")

MONEY = "decimal(18,4)"


def _fact(stg: DataFrame, as_of: datetime, *columns: str | Column) -> DataFrame:
    return stg.select(*columns, instant(as_of).alias("fct_refreshed_at"))


def _has(source: str, target: str) -> Column:
    return F.col(source).isNotNull().alias(target)


def _positive(source: str, target: str) -> Column:
    return flag(F.col(source) > 0).alias(target)


def _money_or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast(MONEY))


def overdue(status: str, due: str, closed: tuple[str, ...], as_of: datetime) -> Column:
    """Still open and due strictly before ``as_of``; false when there is no due date."""
    return ~any_of(status, *closed) & flag(F.col(due) < instant(as_of))


def _title(stg: DataFrame, as_of: datetime, party: str, party_columns: list[str]) -> DataFrame:
    return _fact(
        stg,
        as_of,
        "evento_id",
        "status",
        "status_traduzido",
        F.col("total").alias("valor_total"),
        "valor_pago",
        "valor_nao_pago",
        "descricao",
        "data_vencimento",
        "data_competencia",
        "source_created_at",
        "source_updated_at",
        *party_columns,
        "categoria_id",
        "num_categorias",
        "num_centros_de_custo",
        "foi_renegociado",
        any_of("status", "ACQUITTED").alias("is_pago"),
        any_of("status", "PENDING").alias("is_pendente"),
        any_of("status", "CANCELED").alias("is_cancelado"),
        overdue("status", "data_vencimento", ("ACQUITTED", "CANCELED"), as_of).alias("is_atrasado"),
        _has(f"{party}_id", f"has_{party}"),
    )


def fct_contas_a_receber(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _title(stg, as_of, "cliente", ["cliente_id", "cliente_nome"])


def fct_contas_a_pagar(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _title(stg, as_of, "fornecedor", ["fornecedor_id", "fornecedor_nome"])


def fct_baixas(stg: DataFrame, as_of: datetime) -> DataFrame:
    """Payments; net cash adds interest and fine and takes off the discount."""
    net = (
        F.col("valor_pago")
        + _money_or_zero("valor_juros")
        + _money_or_zero("valor_multa")
        - _money_or_zero("valor_desconto")
    )
    return _fact(
        stg,
        as_of,
        "baixa_id",
        "parcela_id",
        "data_pagamento",
        "valor_pago",
        "valor_juros",
        "valor_multa",
        "valor_desconto",
        net.cast("decimal(22,4)").alias("valor_liquido_caixa"),
        "metodo_pagamento",
        "forma_pagamento",
        "conta_financeira_id",
        "conta_financeira_nome",
        "observacao",
        "source_created_at",
        "source_updated_at",
        _positive("valor_juros", "tem_juros"),
        _positive("valor_multa", "tem_multa"),
        _positive("valor_desconto", "tem_desconto"),
        _has("conta_financeira_id", "has_conta_financeira"),
    )


def fct_cobrancas(stg: DataFrame, as_of: datetime) -> DataFrame:
    states = {
        "is_quitada": "QUITADO",
        "is_registrada": "REGISTRADO",
        "is_aguardando": "AGUARDANDO_CONFIRMACAO",
        "is_cancelada": "CANCELADO",
        "is_expirada": "EXPIRADO",
        "is_invalida": "INVALIDO",
    }
    return _fact(
        stg,
        as_of,
        "cobranca_id",
        "parcela_id",
        "evento_financeiro_id",
        "status",
        "url",
        "valor_cobranca",
        "tipo",
        "data_vencimento",
        "data_emissao",
        "source_updated_at",
        *[any_of("status", word).alias(name) for name, word in states.items()],
        any_of("tipo", "BOLETO").alias("is_boleto"),
        any_of("tipo", "PIX").alias("is_pix"),
    )


def fct_eventos_alteracoes(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _fact(
        stg,
        as_of,
        "evento_id",
        "source_updated_at",
        "tipo_evento",
        any_of("tipo_evento", "CONTAS_RECEBER").alias("is_contas_a_receber"),
        any_of("tipo_evento", "CONTAS_PAGAR").alias("is_contas_a_pagar"),
    )


def fct_notas_fiscais(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _fact(
        stg,
        as_of,
        "nota_id",
        "numero",
        "status",
        "valor",
        "data_emissao",
        "chave_acesso",
        "serie",
        "venda_id",
        "cliente_id",
        "documento_tomador",
        any_of("status", *ISSUED).alias("is_emitida"),
        any_of("status", "CANCELADA").alias("is_cancelada"),
        _has("chave_acesso", "has_chave_acesso"),
        _has("venda_id", "has_venda"),
    )


def fct_notas_fiscais_itens(stg: DataFrame, as_of: datetime) -> DataFrame:
    taxes = ("valor_icms", "valor_ipi", "valor_pis", "valor_cofins")
    total = sum((_money_or_zero(tax) for tax in taxes[1:]), _money_or_zero(taxes[0]))
    return _fact(
        stg,
        as_of,
        "nota_item_id",
        "nota_fiscal_id",
        "chave_acesso",
        "numero_item",
        "produto_id",
        "codigo",
        "descricao",
        "ncm",
        "cfop",
        "quantidade",
        "valor_unitario",
        "valor_total",
        *taxes,
        total.cast("decimal(22,4)").alias("valor_tributos_total"),
        _has("produto_id", "has_produto"),
    )


def fct_notas_servico(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _fact(
        stg,
        as_of,
        "nota_id",
        "numero",
        "status",
        "valor",
        "data_emissao",
        "data_competencia",
        "cliente_id",
        any_of("status", *ISSUED).alias("is_emitida"),
        any_of("status", "CANCELADA").alias("is_cancelada"),
        any_of("status", *FAILED).alias("is_falha"),
        any_of("status", *IN_PROGRESS).alias("is_em_curso"),
    )


def fct_parcelas(stg: DataFrame, as_of: datetime) -> DataFrame:
    """Instalments. Days late are whole days between due and payment, cut toward zero."""
    late = F.expr("cast(extract(DAY from (data_pagamento - data_vencimento)) as int)")
    return _fact(
        stg,
        as_of,
        "parcela_id",
        "evento_financeiro_id",
        "numero_parcela",
        "valor_parcela",
        "valor_bruto",
        "valor_liquido",
        "valor_desconto",
        "valor_juros",
        "valor_multa",
        "data_vencimento",
        "data_pagamento",
        "status",
        "forma_pagamento",
        "conta_financeira_id",
        "conta_financeira_nome",
        "source_created_at",
        "source_updated_at",
        any_of("status", *INSTALMENT_PAID).alias("is_paga"),
        any_of("status", *INSTALMENT_OPEN).alias("is_aberta"),
        any_of("status", *INSTALMENT_CANCELLED).alias("is_cancelada"),
        overdue("status", "data_vencimento", INSTALMENT_PAID + INSTALMENT_CANCELLED, as_of).alias(
            "is_atrasada"
        ),
        _has("data_pagamento", "has_pagamento"),
        _has("conta_financeira_id", "has_conta_financeira"),
        late.alias("dias_atraso_pagamento"),
    )


def fct_saldo_atual(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _fact(
        stg,
        as_of,
        "saldo_atual_id",
        "conta_financeira_id",
        "saldo",
        "snapshot_date",
        "data_snapshot",
        flag(F.col("saldo") < 0).alias("is_negativo"),
        flag(F.col("saldo") == 0).alias("is_zerado"),
    )


def fct_saldo_inicial(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _fact(
        stg,
        as_of,
        "saldo_id",
        "conta_financeira_id",
        "conta_financeira_nome",
        "data_referencia",
        "tipo",
        "saldo",
        "saldo_inicial",
        "saldo_inicial_liquido",
        _has("conta_financeira_id", "has_conta"),
    )


def fct_transferencias(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _fact(
        stg,
        as_of,
        "transferencia_id",
        "data_transferencia",
        "valor",
        "descricao",
        "conta_origem_id",
        "conta_origem_nome",
        "conta_destino_id",
        "conta_destino_nome",
        "source_created_at",
        "source_updated_at",
        _has("conta_origem_id", "has_origem"),
        _has("conta_destino_id", "has_destino"),
        flag(F.col("conta_origem_id") == F.col("conta_destino_id")).alias("is_self_transfer"),
    )


def fct_vendas(stg: DataFrame, as_of: datetime) -> DataFrame:
    """Sales headers. Detail columns are typed NULLs and the two detail flags are constant."""
    return _fact(
        stg,
        as_of,
        "venda_id",
        "venda_id_legado",
        "venda_numero",
        "situacao",
        "tipo",
        "tipo_item",
        "origem",
        "pendente",
        "condicao_pagamento",
        "versao",
        "valor_total",
        "valor_desconto",
        *[
            F.lit(None).cast(MONEY).alias(name)
            for name in ("valor_bruto_detalhe", "valor_frete", "valor_impostos", "valor_liquido")
        ],
        F.lit(None).cast("string").alias("natureza_operacao_nome"),
        F.lit(None).cast("string").alias("condicao_pagamento_detalhe"),
        F.lit(None).cast("int").alias("num_parcelas"),
        "data_venda",
        "source_created_at",
        "source_updated_at",
        "observacoes",
        "cliente_id",
        "cliente_nome",
        "cliente_email",
        "cliente_id_legado",
        "vendedor_id",
        "vendedor_nome",
        "dono_id_legado",
        any_of("situacao", "APROVADO").alias("is_aprovada"),
        any_of("situacao", "CANCELADO").alias("is_cancelada"),
        any_of("situacao", "ESPERANDO_APROVACAO").alias("is_esperando_aprovacao"),
        any_of("tipo_item", "PRODUCT").alias("is_produto"),
        any_of("tipo_item", "SERVICE").alias("is_servico"),
        _has("cliente_id", "has_cliente"),
        F.lit(False).alias("has_vendedor"),
        F.lit(False).alias("has_detalhe"),
    )


def fct_vendas_itens(stg: DataFrame, as_of: datetime) -> DataFrame:
    unit = F.when(F.col("quantidade") > 0, F.col("valor_total") / F.col("quantidade"))
    return _fact(
        stg,
        as_of,
        "venda_item_id",
        "venda_id",
        "produto_id",
        "servico_id",
        "descricao",
        "codigo",
        "quantidade",
        "valor_unitario",
        "valor_desconto",
        "valor_total",
        unit.cast("decimal(28,10)").alias("valor_unitario_liquido"),
        "cfop",
        "ncm",
        "unidade",
        _has("produto_id", "is_produto"),
        _has("servico_id", "is_servico"),
        _positive("valor_desconto", "tem_desconto"),
    )

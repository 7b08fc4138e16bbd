"""One query per staging, dimension, fact and mart model, each with its checking SQL.

The checking SQL states every output column on its own, over the shared raw CTEs; audit columns
(load and refresh times) and untouched JSON bags are left out on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.mapping import RAW, raw_cte, raw_table, statement_roots, uid
from ledgerlake.functions.keys import ZERO_UUID
from ledgerlake.plans import dims, facts, marts, staging, statement

AS_OF = datetime(1998, 6, 1)
AS_OF_SQL = "timestamp '1998-06-01 00:00:00'"
AUDIT = ("raw_loaded_at", "staged_at", "dim_refreshed_at", "fct_refreshed_at", "snapshot_at")

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame, *without: str) -> DataFrame:
    """Drop the named columns and show instants without a zone."""
    df = df.drop(*AUDIT, *without)
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
            for f in df.schema.fields
        ]
    )


def t(x: str) -> str:
    return f"nullif(trim({x}), '')"


def low(x: str) -> str:
    return f"nullif(lower(trim({x})), '')"


def up(x: str) -> str:
    return f"nullif(upper(trim({x})), '')"


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def texts(*names: str) -> dict[str, str]:
    return {n: t(n) for n in names}


def whether(cond: str) -> str:
    return f"coalesce({cond}, false)"


def among(x: str, *words: str) -> str:
    return whether(f"upper({t(x)}) in ({', '.join(repr(w) for w in words)})")


def has(x: str) -> str:
    return f"({x}) is not null"


TIMES = {"source_created_at": "data_criacao", "source_updated_at": "data_alteracao"}
STATUS = "case when lower(trim(status)) in ('ativo', 'inativo') then lower(trim(status)) end"
SERVICE = "case when lower(trim(tipo_servico)) in ('prestado', 'tomado') then lower(trim(tipo_servico)) end"
KIND = (
    "case when lower(trim(tipo_pessoa)) in ('fisica', 'física') then 'pf' "
    "when lower(trim(tipo_pessoa)) in ('juridica', 'jurídica') then 'pj' end"
)


def title(party: str) -> dict[str, str]:
    return {
        "evento_id": "id",
        **texts("status", "status_traduzido"),
        **same("total"),
        "valor_nao_pago": "nao_pago",
        "valor_pago": "pago",
        **texts("descricao"),
        **same("data_vencimento", "data_competencia"),
        **TIMES,
        f"{party}_id": f"nullif({party}__id, '')",
        f"{party}_nome": t(f"{party}__nome"),
        "categoria_id": "categoria",
        "num_categorias": "n_categorias",
        "num_centros_de_custo": "n_centros",
        "foi_renegociado": has("renegociacao"),
    }


STAGE: dict[str, dict[str, str]] = {
    "pessoas": {
        "pessoa_id": "id",
        "pessoa_uuid_legado": "uuid_legado",
        "pessoa_id_legado": "id_legado",
        "pessoa_nome": "trim(nome)",
        "email": low("email"),
        **texts("documento"),
        "tipo_pessoa": KIND,
        **texts("telefone"),
        "ativo": "coalesce(ativo, true)",
        **TIMES,
    },
    "pessoas_detalhe": {
        "pessoa_id": "id",
        "pessoa_nome": "trim(nome)",
        **texts("documento"),
        "email": low("email"),
        **texts("telefone_comercial", "telefone_celular"),
        "tipo_pessoa": KIND,
        **texts("nome_empresa", "rg", "data_nascimento"),
        "optante_simples_nacional": whether("optante_simples_nacional"),
        "orgao_publico": whether("orgao_publico"),
        **texts("observacao", "codigo"),
        "ativo": "coalesce(ativo, true)",
    },
    "conta_conectada": {
        **same("pk"),
        **texts("documento", "razao_social", "nome_fantasia"),
        "email": low("email"),
        **texts("data_fundacao"),
    },
    "vendedores": {"vendedor_id": "id", "vendedor_nome": "trim(nome)"},
    "produtos": {
        "produto_id": "id",
        "produto_nome": t("nome"),
        **texts("codigo", "descricao"),
        **same("preco", "custo", "estoque", "estoque_minimo"),
        **texts("unidade"),
        "status": STATUS,
        **TIMES,
    },
    "produtos_detalhe": {
        "produto_id": "id",
        "produto_nome": t("nome"),
        **texts("codigo", "descricao"),
        **same("preco", "custo", "estoque", "estoque_minimo"),
        **texts("ncm", "cest", "unidade"),
        **same("peso", "altura", "largura", "comprimento", "tributacao", "fotos"),
        "status": STATUS,
        **TIMES,
    },
    "produto_categorias": {
        "categoria_id": "id",
        "categoria_nome": t("nome"),
        **texts("descricao"),
        "ativo": "coalesce(ativo, true)",
    },
    "produto_ncm": {"ncm_codigo": "trim(codigo)", **texts("descricao")},
    "produto_cest": {"cest_codigo": "trim(codigo)", **texts("descricao", "ncm_relacionado")},
    "produto_unidades_medida": {
        "unidade_id": "id",
        **texts("sigla", "descricao"),
        "fracionavel": whether("fracionavel"),
    },
    "produto_ecommerce_marcas": {"marca_ecom_id": "id", "marca_nome": "trim(nome)"},
    "servicos": {
        "servico_id": "id",
        "servico_id_legado": "id_servico",
        "servico_nome": t("nome"),
        **texts("codigo", "descricao"),
        **same("preco", "custo"),
        "status": STATUS,
        "tipo_servico": SERVICE,
    },
    "servicos_detalhe": {
        "servico_id": "id",
        "servico_nome": t("nome"),
        **texts("codigo", "descricao"),
        **same("preco", "custo", "aliquota_iss"),
        **texts("codigo_servico_municipal"),
        **same("tributacao"),
        **texts("observacao"),
        "status": STATUS,
        "tipo_servico": SERVICE,
        **TIMES,
    },
    "categorias_financeiras": {
        "categoria_id": "id",
        "categoria_nome": "trim(nome)",
        "tipo": up("tipo"),
        "categoria_pai_id": "categoria_pai",
        **texts("entrada_dre"),
        "considera_custo_dre": whether("considera_custo_dre"),
        **same("versao"),
    },
    "centros_de_custo": {
        "centro_de_custo_id": "id",
        "centro_de_custo_nome": "trim(nome)",
        **texts("descricao"),
        "ativo": "coalesce(ativo, true)",
    },
    "contas_financeiras": {
        "conta_financeira_id": "id",
        "conta_nome": "trim(nome)",
        "tipo": up("tipo"),
        "banco": up("banco"),
        **same("codigo_banco"),
        **texts("agencia"),
        "numero_conta": t("numero"),
        "ativo": "coalesce(ativo, true)",
        "conta_padrao": whether("conta_padrao"),
        "possui_config_boleto": whether("possui_config_boleto_bancario"),
    },
    "contas_a_receber": title("cliente"),
    "contas_a_pagar": title("fornecedor"),
    "parcelas_detalhe": {
        "parcela_id": "id",
        **same("evento_financeiro_id", "numero_parcela"),
        "valor_parcela": "valor",
        **same("valor_bruto", "valor_liquido"),
        "valor_desconto": "desconto",
        "valor_juros": "juros",
        "valor_multa": "multa",
        **same("data_vencimento", "data_pagamento"),
        **texts("status", "forma_pagamento"),
        **same("conta_financeira_id"),
        "conta_financeira_nome": t("conta_financeira__nome"),
        **TIMES,
    },
    "baixas": {
        "baixa_id": "id",
        **same("parcela_id", "data_pagamento"),
        "valor_pago": "valor",
        "valor_juros": "juros",
        "valor_multa": "multa",
        "valor_desconto": "desconto",
        **texts("metodo_pagamento", "forma_pagamento"),
        **same("conta_financeira_id"),
        "conta_financeira_nome": t("conta_financeira__nome"),
        **texts("observacao"),
        **TIMES,
    },
    "cobrancas": {
        "cobranca_id": "id",
        **same("parcela_id", "evento_financeiro_id"),
        **texts("status", "url"),
        "valor_cobranca": "valor",
        **texts("tipo"),
        **same("data_vencimento", "data_emissao"),
        "source_updated_at": "data_alteracao",
    },
    "transferencias": {
        "transferencia_id": "id",
        **same("data_transferencia", "valor"),
        **texts("descricao"),
        **same("conta_origem_id"),
        "conta_origem_nome": t("conta_origem__nome"),
        **same("conta_destino_id"),
        "conta_destino_nome": t("conta_destino__nome"),
        **TIMES,
    },
    "saldo_inicial": {
        "saldo_id": "id",
        **same("conta_financeira_id"),
        "conta_financeira_nome": t("conta_financeira__nome"),
        **same("data_referencia"),
        "tipo": t("tipo"),
        **same("saldo", "saldo_inicial"),
        "saldo_inicial_liquido": "cast(case when upper(tipo) = 'DESPESA' then -1 else 1 end "
        "* coalesce(saldo_inicial, 0) as decimal(18,4))",
    },
    "saldo_atual": {
        "saldo_atual_id": "id",
        **same("conta_financeira_id"),
        "saldo": "coalesce(saldo_atual, saldo)",
        **same("snapshot_date", "data_snapshot"),
    },
    "eventos_alteracoes": {
        "evento_id": "id",
        "source_updated_at": "data_alteracao",
        **texts("tipo_evento"),
    },
    "vendas": {
        "venda_id": "id",
        "venda_numero": "numero",
        **texts("situacao", "tipo", "tipo_item", "origem"),
        "pendente": whether("pendente"),
        "condicao_pagamento": whether("condicao_pagamento"),
        **same("versao"),
        "valor_total": "total",
        "valor_desconto": "desconto",
        **same("data_venda"),
        "source_created_at": "criado_em",
        "source_updated_at": "data_alteracao",
        **texts("observacoes"),
        "cliente_id": "nullif(cliente__id, '')",
        "cliente_nome": t("cliente__nome"),
        "cliente_email": low("cliente__email"),
        "vendedor_id": "nullif(vendedor__id, '')",
        "vendedor_nome": t("vendedor__nome"),
        "venda_id_legado": "id_legado",
        "cliente_id_legado": "id_legado_cliente",
        "dono_id_legado": "id_legado_dono",
    },
    "vendas_detalhe": {
        "venda_id": "id",
        "venda_numero": "numero",
        **texts("situacao"),
        **same("data_emissao"),
        "source_updated_at": "data_alteracao",
        **same("valor_bruto", "valor_desconto", "valor_frete", "valor_impostos", "valor_liquido"),
        **texts("observacoes"),
        "cliente_id": "cliente__id",
        "cliente_nome": t("cliente__nome"),
        "vendedor_id": "vendedor__id",
        "vendedor_nome": t("vendedor__nome"),
        "natureza_operacao_nome": t("natureza_operacao__nome"),
        **same("condicao_pagamento", "parcelas", "endereco_entrega"),
        "num_parcelas": "n_parcelas",
    },
    "vendas_itens": {
        "venda_item_id": "id",
        **same("venda_id", "produto_id", "servico_id"),
        **texts("descricao", "codigo"),
        **same("quantidade", "valor_unitario"),
        "valor_desconto": "desconto",
        **same("valor_total"),
        **texts("cfop", "ncm", "unidade"),
    },
    "contratos": {
        "contrato_id": "id",
        "contrato_numero": t("numero"),
        **texts("descricao"),
        **same("cliente_id", "valor", "data_inicio", "data_fim"),
        **texts("status"),
        **TIMES,
    },
    "contratos_detalhe": {
        "contrato_id": "id",
        "contrato_numero": t("numero"),
        **texts("descricao"),
        "cliente_id": "cliente__id",
        "cliente_nome": t("cliente__nome"),
        "vendedor_id": "vendedor__id",
        "vendedor_nome": t("vendedor__nome"),
        **same(
            "composicao_de_valor", "condicao_pagamento", "configuracao_recorrencia", "termos",
            "data_emissao", "data_inicio", "data_fim",
        ),
        **texts("status"),
        **same("valor_bruto", "valor_liquido"),
        **TIMES,
    },
    "notas_fiscais": {
        "nota_id": "id",
        **texts("numero", "status"),
        **same("valor", "data_emissao"),
        **texts("chave_acesso", "serie"),
        **same("venda_id", "cliente_id"),
        **texts("documento_tomador"),
    },
    "notas_fiscais_itens": {
        "nota_item_id": "id",
        **same("nota_fiscal_id"),
        **texts("chave_acesso"),
        **same("numero_item", "produto_id"),
        **texts("codigo", "descricao", "ncm", "cfop"),
        **same(
            "quantidade", "valor_unitario", "valor_total", "valor_icms", "valor_ipi", "valor_pis", "valor_cofins"
        ),
    },
    "notas_servico": {
        "nota_id": "id",
        **texts("numero", "status"),
        **same("valor", "data_emissao", "data_competencia", "cliente_id"),
    },
}


def _late(status: str, *closed: str) -> str:
    return f"not {among(status, *closed)} and {whether(f'data_vencimento < {AS_OF_SQL}')}"


def _title_flags(party: str) -> dict[str, str]:
    return {
        "valor_total": "total",
        "is_pago": among("status", "ACQUITTED"),
        "is_pendente": among("status", "PENDING"),
        "is_cancelado": among("status", "CANCELED"),
        "is_atrasado": _late("status", "ACQUITTED", "CANCELED"),
        f"has_{party}": has(f"nullif({party}__id, '')"),
    }


PAID, OPEN, GONE = ("PAGO", "QUITADO", "ACQUITTED"), ("ABERTO", "PENDING", "PENDENTE"), ("CANCELADO", "CANCELED")
NULL_MONEY = "cast(null as decimal(18,4))"

# model → (raw entity, columns beyond staging, staging columns left out)
CURATED: dict[str, tuple[str, dict[str, str], tuple[str, ...]]] = {
    "dim_centros_de_custo": ("centros_de_custo", {}, ()),
    "dim_conta_conectada": (
        "conta_conectada",
        {"has_documento": has(t("documento")), "has_email": has(t("email"))},
        (),
    ),
    "dim_contas_financeiras": (
        "contas_financeiras",
        {
            "natureza": f"case when {up('tipo')} in ('CONTA_CORRENTE', 'POUPANCA', 'INVESTIMENTO') then 'banco' "
            f"when {up('tipo')} = 'CAIXINHA' then 'caixa' when {up('tipo')} like 'CARTAO%' then 'cartao' "
            "else 'outro' end"
        },
        (),
    ),
    "dim_pessoas": (
        "pessoas",
        {
            "is_cliente": "e_cliente",
            "is_fornecedor": "e_fornecedor",
            "has_email": has(t("email")),
            "has_phone": has(t("telefone")),
            "has_documento": has(t("documento")),
            "has_legado": has("uuid_legado"),
            "documento_is_valid": "doc_ok",
        },
        (),
    ),
    "dim_produto_categorias": ("produto_categorias", {}, ()),
    "dim_produto_cest": ("produto_cest", {"has_ncm_relacionado": has(t("ncm_relacionado"))}, ()),
    "dim_produto_ecommerce_marcas": ("produto_ecommerce_marcas", {}, ()),
    "dim_produto_ncm": ("produto_ncm", {}, ()),
    "dim_produto_unidades_medida": ("produto_unidades_medida", {}, ()),
    "dim_vendedores": ("vendedores", {}, ()),
    "fct_baixas": (
        "baixas",
        {
            "valor_liquido_caixa": "cast(valor + coalesce(juros, 0) + coalesce(multa, 0) - coalesce(desconto, 0) "
            "as decimal(22,4))",
            "tem_juros": whether("juros > 0"),
            "tem_multa": whether("multa > 0"),
            "tem_desconto": whether("desconto > 0"),
            "has_conta_financeira": has("conta_financeira_id"),
        },
        (),
    ),
    "fct_cobrancas": (
        "cobrancas",
        {
            "is_quitada": among("status", "QUITADO"),
            "is_registrada": among("status", "REGISTRADO"),
            "is_aguardando": among("status", "AGUARDANDO_CONFIRMACAO"),
            "is_cancelada": among("status", "CANCELADO"),
            "is_expirada": among("status", "EXPIRADO"),
            "is_invalida": among("status", "INVALIDO"),
            "is_boleto": among("tipo", "BOLETO"),
            "is_pix": among("tipo", "PIX"),
        },
        (),
    ),
    "fct_contas_a_receber": ("contas_a_receber", _title_flags("cliente"), ("total",)),
    "fct_contas_a_pagar": ("contas_a_pagar", _title_flags("fornecedor"), ("total",)),
    "fct_eventos_alteracoes": (
        "eventos_alteracoes",
        {
            "is_contas_a_receber": among("tipo_evento", "CONTAS_RECEBER"),
            "is_contas_a_pagar": among("tipo_evento", "CONTAS_PAGAR"),
        },
        (),
    ),
    "fct_notas_fiscais": (
        "notas_fiscais",
        {
            "is_emitida": among("status", "EMITIDA", "CORRIGIDA_SUCESSO"),
            "is_cancelada": among("status", "CANCELADA"),
            "has_chave_acesso": has(t("chave_acesso")),
            "has_venda": has("venda_id"),
        },
        (),
    ),
    "fct_notas_fiscais_itens": (
        "notas_fiscais_itens",
        {
            "valor_tributos_total": "cast(coalesce(valor_icms, 0) + coalesce(valor_ipi, 0) + coalesce(valor_pis, 0) "
            "+ coalesce(valor_cofins, 0) as decimal(22,4))",
            "has_produto": has("produto_id"),
        },
        (),
    ),
    "fct_notas_servico": (
        "notas_servico",
        {
            "is_emitida": among("status", "EMITIDA", "CORRIGIDA_SUCESSO"),
            "is_cancelada": among("status", "CANCELADA"),
            "is_falha": among("status", "FALHA", "FALHA_CANCELAMENTO"),
            "is_em_curso": among(
                "status", "PENDENTE", "PRONTA_ENVIO", "AGUARDANDO_RETORNO", "EM_ESPERA", "EMITINDO"
            ),
        },
        (),
    ),
    "fct_parcelas": (
        "parcelas_detalhe",
        {
            "is_paga": among("status", *PAID),
            "is_aberta": among("status", *OPEN),
            "is_cancelada": among("status", *GONE),
            "is_atrasada": _late("status", *PAID, *GONE),
            "has_pagamento": has("data_pagamento"),
            "has_conta_financeira": has("conta_financeira_id"),
            "dias_atraso_pagamento": "cast(trunc(epoch(data_pagamento - data_vencimento) / 86400) as int)",
        },
        (),
    ),
    "fct_saldo_atual": (
        "saldo_atual",
        {
            "is_negativo": whether("coalesce(saldo_atual, saldo) < 0"),
            "is_zerado": whether("coalesce(saldo_atual, saldo) = 0"),
        },
        (),
    ),
    "fct_saldo_inicial": ("saldo_inicial", {"has_conta": has("conta_financeira_id")}, ()),
    "fct_transferencias": (
        "transferencias",
        {
            "has_origem": has("conta_origem_id"),
            "has_destino": has("conta_destino_id"),
            "is_self_transfer": whether("conta_origem_id = conta_destino_id"),
        },
        (),
    ),
    "fct_vendas": (
        "vendas",
        {
            **{
                n: NULL_MONEY
                for n in ("valor_bruto_detalhe", "valor_frete", "valor_impostos", "valor_liquido")
            },
            "natureza_operacao_nome": "cast(null as string)",
            "condicao_pagamento_detalhe": "cast(null as string)",
            "num_parcelas": "cast(null as int)",
            "is_aprovada": among("situacao", "APROVADO"),
            "is_cancelada": among("situacao", "CANCELADO"),
            "is_esperando_aprovacao": among("situacao", "ESPERANDO_APROVACAO"),
            "is_produto": among("tipo_item", "PRODUCT"),
            "is_servico": among("tipo_item", "SERVICE"),
            "has_cliente": has("nullif(cliente__id, '')"),
            "has_vendedor": "false",
            "has_detalhe": "false",
        },
        (),
    ),
    "fct_vendas_itens": (
        "vendas_itens",
        {
            "valor_unitario_liquido": "case when quantidade > 0 then cast(cast(valor_total as double) / "
            "cast(quantidade as double) as decimal(28,10)) end",
            "is_produto": has("produto_id"),
            "is_servico": has("servico_id"),
            "tem_desconto": whether("desconto > 0"),
        },
        (),
    ),
}

# Columns that only hold an untouched bag or a nested value.
BAGS = ("raw", "perfis_raw", "subitens_raw", "categorias_financeiras_raw")


def _columns(parts: dict[str, str]) -> str:
    return ", ".join(f"{expr} as {name}" for name, expr in parts.items())


def staged(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    raw = statement_roots(spark, sf_dir) if entity == "categorias_dre" else raw_table(spark, sf_dir, entity)
    return getattr(staging, f"stg_{entity}")(raw, AS_OF)


def curated(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    module = dims if model.startswith("dim_") else facts
    if model in WITH_DETAIL:
        own, detail = WITH_DETAIL[model]
        return getattr(module, model)(staged(spark, sf_dir, own), staged(spark, sf_dir, detail), AS_OF)
    source = {"fct_parcelas": "parcelas_detalhe"}.get(model, model[4:])
    return getattr(module, model)(staged(spark, sf_dir, source), AS_OF)


WITH_DETAIL = {
    "dim_contratos": ("contratos", "contratos_detalhe"),
    "dim_produtos": ("produtos", "produtos_detalhe"),
    "dim_servicos": ("servicos", "servicos_detalhe"),
}


def _stage_query(entity: str) -> Query:
    return lambda spark, sf_dir: plain(staged(spark, sf_dir, entity), *BAGS)


def _curated_query(model: str) -> Query:
    return lambda spark, sf_dir: plain(curated(spark, sf_dir, model), *BAGS)


QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

for _entity, _parts in STAGE.items():
    QUERIES[f"stg_{_entity}"] = _stage_query(_entity)
    ORACLE[f"stg_{_entity}"] = f"with {raw_cte(_entity)} select {_columns(_parts)} from raw_{_entity}"

for _model, (_entity, _extra, _without) in CURATED.items():
    _parts = {k: v for k, v in STAGE[_entity].items() if k not in _without} | _extra
    QUERIES[_model] = _curated_query(_model)
    ORACLE[_model] = f"with {raw_cte(_entity)} select {_columns(_parts)} from raw_{_entity}"


# ── models with joins, explodes or trees: their SQL is written out ───────────────────────────────

QUERIES["stg_pessoa_enderecos"] = lambda spark, sf_dir: plain(
    staging.stg_pessoa_enderecos(raw_table(spark, sf_dir, "pessoas_detalhe"), AS_OF)
)
ORACLE["stg_pessoa_enderecos"] = f"""
with people as (select {RAW['pessoas_detalhe'].cols['id']} as pessoa_id, k from {RAW['pessoas_detalhe'].base}),
kinds as (
    select pessoa_id, k, 1 as seq, 0 as a from people where k % 4 in (1, 2)
    union all select pessoa_id, k, 2, 1 from people where k % 4 in (2, 3)
    union all select pessoa_id, k, 3, 0 from people where k % 4 = 3
)
select pessoa_id, cast(seq as bigint) as endereco_seq,
       case a when 0 then concat(lpad(cast(k % 99999 as string), 5, '0'), '-0', cast(10 + k % 90 as string))
              else cast(k as string) end as cep,
       case when a = 0 then concat(lpad(cast(k % 99999 as string), 5, '0'), '0', cast(10 + k % 90 as string))
            when length(cast(k as string)) = 8 then cast(k as string) end as cep_normalizado,
       concat('Rua ', cast(k as string)) as logradouro, cast(a as string) as numero,
       cast(null as string) as complemento, cast(null as string) as bairro, 'X' as cidade,
       cast(case when a = 1 and k % 7 <> 0 then k % 7 end as int) as id_cidade,
       'SP' as estado, cast(null as string) as pais
from kinds"""

ROOT_SIZE = """
sizes as (
    select r_regionkey as r, r_name, count(n_nationkey) as n_sub from region left join nation on n_regionkey = r_regionkey
    group by r_regionkey, r_name
)"""
DRE_STAGE = {
    "categoria_dre_id": uid("39000000", "r"),
    "categoria_nome": "r_name",
    "codigo": "case when r % 2 = 0 then cast(r as string) end",
    "ordem": "case when r = 3 then null else 10 - r end",
    "indica_totalizador": "r = 2",
    "representa_soma_custo_medio": "r = 1",
    "num_subitens": "cast(n_sub as int)",
    "num_categorias_financeiras": "case when r = 1 then 1 else 0 end",
}
QUERIES["stg_categorias_dre"] = _stage_query("categorias_dre")
ORACLE["stg_categorias_dre"] = f"with {ROOT_SIZE} select {_columns(DRE_STAGE)} from sizes"
QUERIES["dim_categorias_dre"] = _curated_query("dim_categorias_dre")
ORACLE["dim_categorias_dre"] = (
    f"with {ROOT_SIZE} select {_columns(DRE_STAGE)}, true as is_raiz, n_sub = 0 as is_folha, "
    "r = 1 as has_categorias_financeiras from sizes"
)

QUERIES["dim_categorias_financeiras"] = _curated_query("dim_categorias_financeiras")
ORACLE["dim_categorias_financeiras"] = f"""
with {raw_cte('categorias_financeiras')}
select {_columns(STAGE['categorias_financeiras'])}, categoria_pai is null as is_raiz,
       not exists (select 1 from raw_categorias_financeiras c where c.categoria_pai = p.id) as is_folha
from raw_categorias_financeiras p"""

_CONTRACT = {k: v for k, v in STAGE["contratos"].items()}
QUERIES["dim_contratos"] = lambda spark, sf_dir: plain(curated(spark, sf_dir, "dim_contratos"), *BAGS)
ORACLE["dim_contratos"] = f"""
with {raw_cte('contratos')}, {raw_cte('contratos_detalhe')},
s as (select {_columns(_CONTRACT)} from raw_contratos),
d as (select id, vendedor__id as vendedor_id, {t('vendedor__nome')} as vendedor_nome, composicao_de_valor,
             condicao_pagamento, configuracao_recorrencia, termos, data_emissao, valor_bruto, valor_liquido
      from raw_contratos_detalhe)
select s.*, d.* exclude (id), data_fim < {AS_OF_SQL} as is_vencido, {among('status', 'ATIVO')} as is_ativo,
       cliente_id is not null as has_cliente, vendedor_id is not null as has_vendedor,
       valor_liquido is not null as has_detalhe, configuracao_recorrencia is not null as is_recorrente
from s left join d on d.id = s.contrato_id"""

MARGINS = """
case when preco > 0 then cast(preco - coalesce(custo, 0) as decimal(18,4)) end as margem_absoluta,
case when preco > 0 then cast(cast(preco - coalesce(custo, 0) as double) / cast(preco as double)
     as decimal(28,10)) end as margem_percentual"""
QUERIES["dim_produtos"] = _curated_query("dim_produtos")
ORACLE["dim_produtos"] = f"""
with {raw_cte('produtos')}, {raw_cte('produtos_detalhe')},
s as (select {_columns(STAGE['produtos'])} from raw_produtos),
d as (select id, {t('ncm')} as ncm, {t('cest')} as cest, peso, altura, largura, comprimento, tributacao, fotos
      from raw_produtos_detalhe)
select s.*, d.* exclude (id), {MARGINS},
       {whether('estoque < estoque_minimo')} as abaixo_estoque_minimo,
       cast(cast(altura as double) * cast(largura as double) * cast(comprimento as double) / 1000000
            as decimal(28,10)) as volume_m3,
       ncm is not null as has_ncm, tributacao is not null as has_tributacao,
       {whether("fotos = '[{\"u\":1}]'")} as has_fotos
from s left join d on d.id = s.produto_id"""

QUERIES["dim_servicos"] = _curated_query("dim_servicos")
ORACLE["dim_servicos"] = f"""
with {raw_cte('servicos')}, {raw_cte('servicos_detalhe')},
s as (select {_columns(STAGE['servicos'])} from raw_servicos),
d as (select id, aliquota_iss, {t('codigo_servico_municipal')} as codigo_servico_municipal, tributacao,
             {t('observacao')} as observacao from raw_servicos_detalhe)
select s.*, d.* exclude (id), {MARGINS}, aliquota_iss is not null as has_aliquota_iss,
       codigo_servico_municipal is not null as has_codigo_municipal, tributacao is not null as has_tributacao
from s left join d on d.id = s.servico_id"""

# ── marts ────────────────────────────────────────────────────────────────────────────────────────

QUERIES["fin_receita_diaria"] = lambda spark, sf_dir: plain(
    marts.fin_receita_diaria(curated(spark, sf_dir, "fct_contas_a_receber"))
)
QUERIES["fin_despesa_diaria"] = lambda spark, sf_dir: plain(
    marts.fin_despesa_diaria(curated(spark, sf_dir, "fct_contas_a_pagar"))
)
for _name, _entity, _total, _paid in (
    ("fin_receita_diaria", "contas_a_receber", "faturamento", "recebido"),
    ("fin_despesa_diaria", "contas_a_pagar", "total", "pago"),
):
    ORACLE[_name] = f"""
with {raw_cte(_entity)}
select cast(r.data_competencia as date) as dia, cast(count(*) as int) as qtd,
       cast(sum(r.total) as decimal(14,2)) as {_total}, cast(sum(r.pago) as decimal(14,2)) as {_paid},
       cast(sum(r.nao_pago) as decimal(14,2)) as em_aberto
from raw_{_entity} r
where r.data_competencia is not null and not {among('r.status', 'CANCELED')}
group by 1"""

QUERIES["vendas_diaria"] = lambda spark, sf_dir: plain(marts.vendas_diaria(curated(spark, sf_dir, "fct_vendas")))
ORACLE["vendas_diaria"] = f"""
with {raw_cte('vendas')}
select v.data_venda as dia, coalesce({t('v.tipo_item')}, 'OUTRO') as tipo_item, cast(count(*) as int) as qtd,
       cast(sum(v.total) as decimal(14,2)) as valor_total
from raw_vendas v where v.data_venda is not null and not {among('v.situacao', 'CANCELADO')}
group by 1, 2"""

QUERIES["saldo_inicial"] = lambda spark, sf_dir: plain(
    marts.saldo_inicial(curated(spark, sf_dir, "fct_saldo_inicial"))
)
ORACLE["saldo_inicial"] = f"""
with {raw_cte('saldo_inicial')}
select cast(coalesce(sum(case when upper(b.tipo) = 'DESPESA' then -1 else 1 end * coalesce(b.saldo_inicial, 0)), 0)
       as decimal(14,2)) as saldo_inicial from raw_saldo_inicial b"""

QUERIES["clientes_resumo"] = lambda spark, sf_dir: plain(
    marts.clientes_resumo(curated(spark, sf_dir, "dim_pessoas"), AS_OF)
)
ORACLE["clientes_resumo"] = f"""
with {raw_cte('pessoas')}
select coalesce({KIND}, 'desconhecido') as tipo_pessoa, count(*) as total_clientes,
       count({t('p.email')}) as com_email, count({t('p.telefone')}) as com_telefone,
       count({t('p.documento')}) as com_documento, count(*) filter (p.doc_ok) as com_documento_valido
from raw_pessoas p group by 1"""

QUERIES["dre_valores"] = lambda spark, sf_dir: plain(
    statement.dre_valores(
        curated(spark, sf_dir, "fct_contas_a_receber"), curated(spark, sf_dir, "fct_contas_a_pagar")
    )
)
ORACLE["dre_valores"] = f"""
with {raw_cte('contas_a_receber')}, {raw_cte('contas_a_pagar')},
both_sides as (
    select categoria, total as v, data_competencia, data_vencimento, status from raw_contas_a_receber
    union all select categoria, -total, data_competencia, data_vencimento, status from raw_contas_a_pagar
), kept as (select * from both_sides b where categoria is not null and not {among('b.status', 'CANCELED')}),
days as (
    select 'competencia' as regime, categoria, v, cast(data_competencia as date) as dia from kept
    union all select 'vencimento', categoria, v, cast(data_vencimento as date) from kept
)
select regime, categoria as categoria_id, dia, cast(sum(v) as decimal(14,2)) as valor
from days where dia is not null group by regime, categoria, dia"""

QUERIES["dre_estrutura"] = lambda spark, sf_dir: plain(
    statement.dre_estrutura(
        statement_roots(spark, sf_dir), curated(spark, sf_dir, "dim_categorias_financeiras")
    )
)
ORACLE["dre_estrutura"] = f"""
with {raw_cte('categorias_financeiras')},
cat as (select id, trim(nome) as nome, categoria_pai from raw_categorias_financeiras),
root as (
    select r_regionkey as r, r_name,
           case when r_regionkey % 2 = 0 then concat(' ', cast(r_regionkey as string)) else ' ' end as codigo,
           case r_regionkey when 2 then true when 4 then null else false end as total_flag,
           row_number() over (order by case when r_regionkey = 3 then null else 10 - r_regionkey end nulls last) as n1
    from region
),
sub as (
    select n1, n_nationkey, n_name, row_number() over (partition by n1 order by n_nationkey) as n2
    from root join nation on n_regionkey = r where total_flag = false
),
leaf as (
    select n1, n2, row_number() over (partition by n1, n2 order by s) as n4,
           {uid('30000000', 'n * 10 + s')} as id, concat('Leaf ', cast(n * 10 + s as string)) as nome
    from sub join (select distinct c_nationkey as n, {RAW['categorias_financeiras'].base.split('select distinct c_nationkey as n, ')[1].split(' as s from')[0]} as s from customer) l on l.n = n_nationkey
),
placed as (
    select leaf.*, coalesce(own.categoria_pai, '{ZERO_UUID}') as pkey,
           coalesce(up.nome, '(Sem categoria pai)') as pname
    from leaf left join cat own on own.id = leaf.id left join cat up on up.id = own.categoria_pai
),
ranked as (select *, dense_rank() over (partition by n1, n2 order by pname) as n3 from placed),
node as (
    select n1, 0 as n2, 0 as n3, 0 as n4, 1 as nivel, case when total_flag then 'totalizador' else 'grupo' end as tipo,
           r_name as descricao, codigo, cast(null as string) as categoria_id
    from root where total_flag is not null
    union all select n1, n2, 0, 0, 2, 'subgrupo', n_name, concat('N', cast(n_nationkey as string)), null from sub
    union all select distinct n1, n2, n3, 0, 3, 'categoria_pai', pname, null, pkey from ranked
    union all select n1, n2, n3, n4, 4, 'categoria', nome, null, id from ranked
)
select row_number() over (order by n1, n2, n3, nivel, n4, node.categoria_id) as seq, cast(n1 as int) as ord_n1,
       cast(n2 as int) as ord_n2, cast(n3 as int) as ord_n3, cast(n4 as int) as ord_n4, nivel, tipo, descricao, codigo,
       case when nivel = 3 then null else node.categoria_id end as categoria_id
from node"""

"""Staging: typed, trimmed and renamed projections of the raw tables.

Each builder is one narrow ``select`` over one raw table (no shuffle), so column pruning and filters
reach the Parquet scan. Nested objects are typed structs in raw: only the fields named here are read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import (
    flag,
    keep_values,
    lower_text,
    normalize_cep,
    rename_values,
    text,
    upper_text,
    uuid_text,
)
from ledgerlake.functions.time import instant

# Spellings of the person kinds in the source system.
PERSON_KINDS = {"fisica": "pf", "física": "pf", "juridica": "pj", "jurídica": "pj"}


def _stage(raw: DataFrame, as_of: datetime, *columns: Column | str) -> DataFrame:
    return raw.select(
        *columns,
        F.col("loaded_at").alias("raw_loaded_at"),
        instant(as_of).alias("staged_at"),
    )


def _as(source: str, target: str) -> Column:
    return F.col(source).alias(target)


def _text(source: str, target: str | None = None) -> Column:
    return text(source).alias(target or source.split(".")[-1])


def _texts(*names: str) -> list[Column]:
    return [_text(name) for name in names]


def _trim(source: str, target: str) -> Column:
    return F.trim(source).alias(target)


def _or(source: str, default: bool, target: str | None = None) -> Column:
    return F.coalesce(F.col(source), F.lit(default)).alias(target or source)


def _uuid(source: str, target: str) -> Column:
    """Id inside an object; empty text counts as absent, other malformed text raises."""
    return uuid_text(F.nullif(F.col(source), F.lit(""))).alias(target)


def _uuid_strict(source: str, target: str) -> Column:
    """Id inside an object; empty text is malformed too."""
    return uuid_text(source).alias(target)


def _count(source: str, target: str) -> Column:
    return F.coalesce(F.array_size(source), F.lit(0)).alias(target)


def _json_count(source: str, target: str) -> Column:
    return F.coalesce(F.json_array_length(source), F.lit(0)).alias(target)


def _audit() -> list[Column]:
    return [_as("data_criacao", "source_created_at"), _as("data_alteracao", "source_updated_at")]


# ── people and account holder ────────────────────────────────────────────────────────────────────


def stg_pessoas(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "pessoa_id"),
        _as("uuid_legado", "pessoa_uuid_legado"),
        _as("id_legado", "pessoa_id_legado"),
        _trim("nome", "pessoa_nome"),
        lower_text("email").alias("email"),
        _text("documento"),
        rename_values("tipo_pessoa", PERSON_KINDS).alias("tipo_pessoa"),
        _text("telefone"),
        _or("ativo", True),
        _as("perfis", "perfis_raw"),
        *_audit(),
    )


def stg_pessoas_detalhe(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "pessoa_id"),
        _trim("nome", "pessoa_nome"),
        _text("documento"),
        lower_text("email").alias("email"),
        *_texts("telefone_comercial", "telefone_celular"),
        rename_values("tipo_pessoa", PERSON_KINDS).alias("tipo_pessoa"),
        *_texts("nome_empresa", "rg", "data_nascimento"),
        _or("optante_simples_nacional", False),
        _or("orgao_publico", False),
        *_texts("observacao", "codigo"),
        _or("ativo", True),
    )


def stg_pessoa_enderecos(raw: DataFrame, as_of: datetime) -> DataFrame:
    """One row per address of a person, numbered from 1; addresses without any content are left out."""
    exploded = raw.select("id", "loaded_at", F.posexplode("enderecos").alias("pos", "e"))
    return _stage(
        exploded,
        as_of,
        _as("id", "pessoa_id"),
        (F.col("pos") + 1).cast("bigint").alias("endereco_seq"),
        _text("e.cep"),
        normalize_cep("e.cep").alias("cep_normalizado"),
        *_texts("e.logradouro", "e.numero", "e.complemento", "e.bairro", "e.cidade"),
        F.nullif(F.col("e.id_cidade"), F.lit(0)).alias("id_cidade"),
        *_texts("e.estado", "e.pais"),
    ).where("cep is not null or logradouro is not null or cidade is not null")


def stg_conta_conectada(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        "pk",
        *_texts("documento", "razao_social", "nome_fantasia"),
        lower_text("email").alias("email"),
        _text("data_fundacao"),
        "raw",
    )


def stg_vendedores(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(raw, as_of, _as("id", "vendedor_id"), _trim("nome", "vendedor_nome"))


# ── catalogue ────────────────────────────────────────────────────────────────────────────────────


def _on_off(source: str = "status") -> Column:
    return keep_values(source, "ativo", "inativo").alias("status")


def stg_produtos(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "produto_id"),
        _text("nome", "produto_nome"),
        *_texts("codigo", "descricao"),
        "preco",
        "custo",
        "estoque",
        "estoque_minimo",
        _text("unidade"),
        _on_off(),
        *_audit(),
    )


def stg_produtos_detalhe(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "produto_id"),
        _text("nome", "produto_nome"),
        *_texts("codigo", "descricao"),
        "preco",
        "custo",
        "estoque",
        "estoque_minimo",
        *_texts("ncm", "cest", "unidade"),
        "peso",
        "altura",
        "largura",
        "comprimento",
        "tributacao",
        "fotos",
        _on_off(),
        *_audit(),
    )


def stg_produto_categorias(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "categoria_id"),
        _text("nome", "categoria_nome"),
        _text("descricao"),
        _or("ativo", True),
        "raw",
    )


def stg_produto_ncm(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(raw, as_of, _trim("codigo", "ncm_codigo"), _text("descricao"), "raw")


def stg_produto_cest(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(raw, as_of, _trim("codigo", "cest_codigo"), *_texts("descricao", "ncm_relacionado"), "raw")


def stg_produto_unidades_medida(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw, as_of, _as("id", "unidade_id"), *_texts("sigla", "descricao"), _or("fracionavel", False), "raw"
    )


def stg_produto_ecommerce_marcas(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(raw, as_of, _as("id", "marca_ecom_id"), _trim("nome", "marca_nome"), "raw")


def _service_kind() -> Column:
    return keep_values("tipo_servico", "prestado", "tomado").alias("tipo_servico")


def stg_servicos(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "servico_id"),
        _as("id_servico", "servico_id_legado"),
        _text("nome", "servico_nome"),
        *_texts("codigo", "descricao"),
        "preco",
        "custo",
        _on_off(),
        _service_kind(),
    )


def stg_servicos_detalhe(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "servico_id"),
        _text("nome", "servico_nome"),
        *_texts("codigo", "descricao"),
        "preco",
        "custo",
        "aliquota_iss",
        _text("codigo_servico_municipal"),
        "tributacao",
        _text("observacao"),
        _on_off(),
        _service_kind(),
        *_audit(),
    )


# ── finance: master data ─────────────────────────────────────────────────────────────────────────


def stg_categorias_financeiras(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "categoria_id"),
        _trim("nome", "categoria_nome"),
        upper_text("tipo").alias("tipo"),
        _as("categoria_pai", "categoria_pai_id"),
        _text("entrada_dre"),
        _or("considera_custo_dre", False),
        "versao",
    )


def stg_categorias_dre(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "categoria_dre_id"),
        _text("descricao", "categoria_nome"),
        _text("codigo"),
        _as("posicao", "ordem"),
        _or("indica_totalizador", False),
        _or("representa_soma_custo_medio", False),
        _as("subitens", "subitens_raw"),
        _as("categorias_financeiras", "categorias_financeiras_raw"),
        _count("subitens", "num_subitens"),
        _count("categorias_financeiras", "num_categorias_financeiras"),
        "raw",
    )


def stg_centros_de_custo(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "centro_de_custo_id"),
        _trim("nome", "centro_de_custo_nome"),
        _text("descricao"),
        _or("ativo", True),
    )


def stg_contas_financeiras(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "conta_financeira_id"),
        _trim("nome", "conta_nome"),
        upper_text("tipo").alias("tipo"),
        upper_text("banco").alias("banco"),
        "codigo_banco",
        _text("agencia"),
        _text("numero", "numero_conta"),
        _or("ativo", True),
        _or("conta_padrao", False),
        _or("possui_config_boleto_bancario", False, "possui_config_boleto"),
    )


# ── finance: titles, instalments, payments, balances ─────────────────────────────────────────────


def _title(raw: DataFrame, as_of: datetime, party: str) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "evento_id"),
        *_texts("status", "status_traduzido"),
        "total",
        _as("nao_pago", "valor_nao_pago"),
        _as("pago", "valor_pago"),
        _text("descricao"),
        "data_vencimento",
        "data_competencia",
        *_audit(),
        _uuid(f"{party}.id", f"{party}_id"),
        _text(f"{party}.nome", f"{party}_nome"),
        uuid_text(F.nullif(F.get(F.col("categorias"), 0)["id"], F.lit(""))).alias("categoria_id"),
        _count("categorias", "num_categorias"),
        _count("centros_de_custo", "num_centros_de_custo"),
        F.col("renegociacao").isNotNull().alias("foi_renegociado"),
    )


def stg_contas_a_receber(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _title(raw, as_of, "cliente")


def stg_contas_a_pagar(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _title(raw, as_of, "fornecedor")


def stg_parcelas_detalhe(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "parcela_id"),
        "evento_financeiro_id",
        "numero_parcela",
        _as("valor", "valor_parcela"),
        "valor_bruto",
        "valor_liquido",
        _as("desconto", "valor_desconto"),
        _as("juros", "valor_juros"),
        _as("multa", "valor_multa"),
        "data_vencimento",
        "data_pagamento",
        *_texts("status", "forma_pagamento"),
        "conta_financeira_id",
        _text("conta_financeira.nome", "conta_financeira_nome"),
        *_audit(),
    )


def stg_baixas(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "baixa_id"),
        "parcela_id",
        "data_pagamento",
        _as("valor", "valor_pago"),
        _as("juros", "valor_juros"),
        _as("multa", "valor_multa"),
        _as("desconto", "valor_desconto"),
        *_texts("metodo_pagamento", "forma_pagamento"),
        "conta_financeira_id",
        _text("conta_financeira.nome", "conta_financeira_nome"),
        _text("observacao"),
        *_audit(),
    )


def stg_cobrancas(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "cobranca_id"),
        "parcela_id",
        "evento_financeiro_id",
        *_texts("status", "url"),
        _as("valor", "valor_cobranca"),
        _text("tipo"),
        "data_vencimento",
        "data_emissao",
        _as("data_alteracao", "source_updated_at"),
    )


def stg_transferencias(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "transferencia_id"),
        "data_transferencia",
        "valor",
        _text("descricao"),
        "conta_origem_id",
        _text("conta_origem.nome", "conta_origem_nome"),
        "conta_destino_id",
        _text("conta_destino.nome", "conta_destino_nome"),
        *_audit(),
        "raw",
    )


def stg_saldo_inicial(raw: DataFrame, as_of: datetime) -> DataFrame:
    """Opening balances arrive unsigned; the record's own kind decides the sign."""
    kind = F.get_json_object("raw", "$.tipo")
    amount = F.coalesce(F.col("saldo_inicial"), F.lit(0).cast("decimal(18,4)"))
    return _stage(
        raw,
        as_of,
        _as("id", "saldo_id"),
        "conta_financeira_id",
        _text("conta_financeira.nome", "conta_financeira_nome"),
        "data_referencia",
        text(kind).alias("tipo"),
        "saldo",
        "saldo_inicial",
        F.when(flag(F.upper(kind) == "DESPESA"), -amount).otherwise(amount).alias("saldo_inicial_liquido"),
        "raw",
    )


def stg_saldo_atual(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "saldo_atual_id"),
        "conta_financeira_id",
        F.coalesce("saldo_atual", "saldo").alias("saldo"),
        "snapshot_date",
        "data_snapshot",
    )


def stg_eventos_alteracoes(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw, as_of, _as("id", "evento_id"), _as("data_alteracao", "source_updated_at"), _text("tipo_evento")
    )


# ── sales, contracts, invoices ───────────────────────────────────────────────────────────────────


def stg_vendas(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "venda_id"),
        _as("numero", "venda_numero"),
        *_texts("situacao", "tipo", "tipo_item", "origem"),
        _or("pendente", False),
        _or("condicao_pagamento", False),
        "versao",
        _as("total", "valor_total"),
        _as("desconto", "valor_desconto"),
        "data_venda",
        _as("criado_em", "source_created_at"),
        _as("data_alteracao", "source_updated_at"),
        _text("observacoes"),
        _uuid("cliente.id", "cliente_id"),
        _text("cliente.nome", "cliente_nome"),
        lower_text("cliente.email").alias("cliente_email"),
        _uuid("vendedor.id", "vendedor_id"),
        _text("vendedor.nome", "vendedor_nome"),
        _as("id_legado", "venda_id_legado"),
        _as("id_legado_cliente", "cliente_id_legado"),
        _as("id_legado_dono", "dono_id_legado"),
    )


def stg_vendas_detalhe(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "venda_id"),
        _as("numero", "venda_numero"),
        _text("situacao"),
        "data_emissao",
        _as("data_alteracao", "source_updated_at"),
        "valor_bruto",
        "valor_desconto",
        "valor_frete",
        "valor_impostos",
        "valor_liquido",
        _text("observacoes"),
        _uuid_strict("cliente.id", "cliente_id"),
        _text("cliente.nome", "cliente_nome"),
        _uuid_strict("vendedor.id", "vendedor_id"),
        _text("vendedor.nome", "vendedor_nome"),
        _text("natureza_operacao.nome", "natureza_operacao_nome"),
        "condicao_pagamento",
        "parcelas",
        "endereco_entrega",
        _json_count("parcelas", "num_parcelas"),
    )


def stg_vendas_itens(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "venda_item_id"),
        "venda_id",
        "produto_id",
        "servico_id",
        *_texts("descricao", "codigo"),
        "quantidade",
        "valor_unitario",
        _as("desconto", "valor_desconto"),
        "valor_total",
        *_texts("cfop", "ncm", "unidade"),
    )


def stg_contratos(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "contrato_id"),
        _text("numero", "contrato_numero"),
        _text("descricao"),
        "cliente_id",
        "valor",
        "data_inicio",
        "data_fim",
        _text("status"),
        *_audit(),
        "raw",
    )


def stg_contratos_detalhe(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "contrato_id"),
        _text("numero", "contrato_numero"),
        _text("descricao"),
        _uuid_strict("cliente.id", "cliente_id"),
        _text("cliente.nome", "cliente_nome"),
        _uuid_strict("vendedor.id", "vendedor_id"),
        _text("vendedor.nome", "vendedor_nome"),
        "composicao_de_valor",
        "condicao_pagamento",
        "configuracao_recorrencia",
        "termos",
        "data_emissao",
        "data_inicio",
        "data_fim",
        _text("status"),
        "valor_bruto",
        "valor_liquido",
        *_audit(),
    )


def stg_notas_fiscais(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "nota_id"),
        *_texts("numero", "status"),
        "valor",
        "data_emissao",
        *_texts("chave_acesso", "serie"),
        "venda_id",
        "cliente_id",
        _text("documento_tomador"),
        "raw",
    )


def stg_notas_fiscais_itens(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "nota_item_id"),
        "nota_fiscal_id",
        _text("chave_acesso"),
        "numero_item",
        "produto_id",
        *_texts("codigo", "descricao", "ncm", "cfop"),
        "quantidade",
        "valor_unitario",
        "valor_total",
        "valor_icms",
        "valor_ipi",
        "valor_pis",
        "valor_cofins",
    )


def stg_notas_servico(raw: DataFrame, as_of: datetime) -> DataFrame:
    return _stage(
        raw,
        as_of,
        _as("id", "nota_id"),
        *_texts("numero", "status"),
        "valor",
        "data_emissao",
        "data_competencia",
        "cliente_id",
        "raw",
    )

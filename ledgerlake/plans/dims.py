"""Dimensions: enriched, flagged copies of the staged master data."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import any_of, cnpj_is_valid, cpf_is_valid, flag
from ledgerlake.functions.documents import digits_of
from ledgerlake.functions.time import instant

# Account kinds of the source system by nature.
ACCOUNT_NATURE = {
    "banco": ("CONTA_CORRENTE", "POUPANCA", "INVESTIMENTO"),
    "caixa": ("CAIXINHA",),
    "cartao": ("CARTAO_CREDITO", "CARTAO_DEBITO"),
}
RATIO = "decimal(28,10)"


def _refreshed(df: DataFrame, as_of: datetime) -> DataFrame:
    return df.withColumn("dim_refreshed_at", instant(as_of))


def _has(source: str, target: str) -> Column:
    return F.col(source).isNotNull().alias(target)


def _plain(stg: DataFrame, as_of: datetime, *columns: str | Column) -> DataFrame:
    return _refreshed(stg.select(*columns), as_of)


def dim_categorias_dre(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(
        stg,
        as_of,
        "categoria_dre_id",
        "categoria_nome",
        "codigo",
        "ordem",
        "indica_totalizador",
        "representa_soma_custo_medio",
        "num_subitens",
        "num_categorias_financeiras",
        F.lit(True).alias("is_raiz"),
        (F.col("num_subitens") == 0).alias("is_folha"),
        (F.col("num_categorias_financeiras") > 0).alias("has_categorias_financeiras"),
    )


def dim_categorias_financeiras(stg: DataFrame, as_of: datetime) -> DataFrame:
    """Leaf detection: a category that no other category names as its parent.

    Parents are made distinct before the join, so a parent of very many children is one row (the
    distinct combines map-side) and the join cannot multiply rows.
    """
    parents = (
        stg.where(F.col("categoria_pai_id").isNotNull())
        .select(F.col("categoria_pai_id").alias("parent_id"))
        .distinct()
    )
    joined = stg.join(parents, F.col("categoria_id") == F.col("parent_id"), "left")
    return _plain(
        joined,
        as_of,
        "categoria_id",
        "categoria_nome",
        "tipo",
        "categoria_pai_id",
        "entrada_dre",
        "considera_custo_dre",
        "versao",
        F.col("categoria_pai_id").isNull().alias("is_raiz"),
        F.col("parent_id").isNull().alias("is_folha"),
    )


def dim_centros_de_custo(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(stg, as_of, "centro_de_custo_id", "centro_de_custo_nome", "descricao", "ativo")


def dim_conta_conectada(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(
        stg,
        as_of,
        "pk",
        "documento",
        "razao_social",
        "nome_fantasia",
        "email",
        "data_fundacao",
        _has("documento", "has_documento"),
        _has("email", "has_email"),
    )


def account_nature(kind: str) -> Column:
    out: Column = F.lit("outro")
    for nature, kinds in ACCOUNT_NATURE.items():
        out = F.when(F.col(kind).isin(*kinds), F.lit(nature)).otherwise(out)
    return out


def dim_contas_financeiras(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(
        stg,
        as_of,
        "conta_financeira_id",
        "conta_nome",
        "tipo",
        account_nature("tipo").alias("natureza"),
        "banco",
        "codigo_banco",
        "agencia",
        "numero_conta",
        "ativo",
        "conta_padrao",
        "possui_config_boleto",
    )


def dim_contratos(stg: DataFrame, detail: DataFrame, as_of: datetime) -> DataFrame:
    """Contracts with their detail; ``is_vencido`` stays NULL for an open end."""
    extra = detail.select(
        "contrato_id",
        "vendedor_id",
        "vendedor_nome",
        "composicao_de_valor",
        "condicao_pagamento",
        "configuracao_recorrencia",
        "termos",
        "data_emissao",
        "valor_bruto",
        "valor_liquido",
    )
    return _plain(
        stg.join(extra, "contrato_id", "left"),
        as_of,
        "contrato_id",
        "contrato_numero",
        "descricao",
        "cliente_id",
        "vendedor_id",
        "vendedor_nome",
        "valor",
        "valor_bruto",
        "valor_liquido",
        "data_emissao",
        "data_inicio",
        "data_fim",
        "status",
        "composicao_de_valor",
        "condicao_pagamento",
        "configuracao_recorrencia",
        "termos",
        "source_created_at",
        "source_updated_at",
        (F.col("data_fim") < instant(as_of)).alias("is_vencido"),
        any_of("status", "ATIVO").alias("is_ativo"),
        _has("cliente_id", "has_cliente"),
        _has("vendedor_id", "has_vendedor"),
        _has("valor_liquido", "has_detalhe"),
        _has("configuracao_recorrencia", "is_recorrente"),
    )


def with_document_check(people: DataFrame) -> DataFrame:
    """Add ``documento_is_valid``, by the rule of the person kind; NULL where the kind is unknown.

    The digits become a column first, so the check refers to them instead of repeating their extraction.
    """
    judged = F.when(F.col("tipo_pessoa") == "pj", cnpj_is_valid("_digits", clean=True)).when(
        F.col("tipo_pessoa") == "pf", cpf_is_valid("_digits", clean=True)
    )
    return (
        people.withColumn("_digits", digits_of("documento"))
        .withColumn("documento_is_valid", judged)
        .drop("_digits")
    )


def dim_pessoas(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(
        with_document_check(stg),
        as_of,
        "pessoa_id",
        "pessoa_uuid_legado",
        "pessoa_id_legado",
        "pessoa_nome",
        "email",
        "documento",
        "tipo_pessoa",
        "telefone",
        "ativo",
        F.array_contains("perfis_raw", "Cliente").alias("is_cliente"),
        F.array_contains("perfis_raw", "Fornecedor").alias("is_fornecedor"),
        "source_created_at",
        "source_updated_at",
        _has("email", "has_email"),
        _has("telefone", "has_phone"),
        _has("documento", "has_documento"),
        _has("pessoa_uuid_legado", "has_legado"),
        "documento_is_valid",
    )


def dim_produto_categorias(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(stg, as_of, "categoria_id", "categoria_nome", "descricao", "ativo")


def dim_produto_cest(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(
        stg,
        as_of,
        "cest_codigo",
        "descricao",
        "ncm_relacionado",
        _has("ncm_relacionado", "has_ncm_relacionado"),
    )


def dim_produto_ecommerce_marcas(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(stg, as_of, "marca_ecom_id", "marca_nome")


def dim_produto_ncm(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(stg, as_of, "ncm_codigo", "descricao")


def dim_produto_unidades_medida(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(stg, as_of, "unidade_id", "sigla", "descricao", "fracionavel")


def margin(price: str = "preco", cost: str = "custo") -> tuple[Column, Column]:
    """Absolute margin and its share of the price; both NULL where there is no positive price."""
    zero = F.lit(0).cast("decimal(18,4)")
    gain = F.col(price) - F.coalesce(F.col(cost), zero)
    return (
        F.when(F.col(price) > 0, gain.cast("decimal(18,4)")),
        F.when(F.col(price) > 0, (gain / F.col(price)).cast(RATIO)),
    )


def dim_produtos(stg: DataFrame, detail: DataFrame, as_of: datetime) -> DataFrame:
    """Products with detail, margins, stock alarm and volume (sides in cm, volume in m³)."""
    sides = ("altura", "largura", "comprimento")
    extra = detail.select("produto_id", "ncm", "cest", "peso", *sides, "tributacao", "fotos")
    gain, share = margin()
    a, b, c = (F.col(side).cast("decimal(12,4)") for side in sides)
    return _plain(
        stg.join(extra, "produto_id", "left"),
        as_of,
        "produto_id",
        "produto_nome",
        "codigo",
        "descricao",
        "preco",
        "custo",
        gain.alias("margem_absoluta"),
        share.alias("margem_percentual"),
        "estoque",
        "estoque_minimo",
        flag(F.col("estoque") < F.col("estoque_minimo")).alias("abaixo_estoque_minimo"),
        "unidade",
        "status",
        "ncm",
        "cest",
        "peso",
        *sides,
        "tributacao",
        "fotos",
        (a * b * c / F.lit(1000000)).cast(RATIO).alias("volume_m3"),
        _has("ncm", "has_ncm"),
        _has("tributacao", "has_tributacao"),
        flag(F.json_array_length("fotos") > 0).alias("has_fotos"),
        "source_created_at",
        "source_updated_at",
    )


def dim_servicos(stg: DataFrame, detail: DataFrame, as_of: datetime) -> DataFrame:
    extra = detail.select(
        "servico_id", "aliquota_iss", "codigo_servico_municipal", "tributacao", "observacao"
    )
    gain, share = margin()
    return _plain(
        stg.join(extra, "servico_id", "left"),
        as_of,
        "servico_id",
        "servico_id_legado",
        "servico_nome",
        "codigo",
        "descricao",
        "preco",
        "custo",
        gain.alias("margem_absoluta"),
        share.alias("margem_percentual"),
        "status",
        "tipo_servico",
        "aliquota_iss",
        "codigo_servico_municipal",
        "tributacao",
        "observacao",
        _has("aliquota_iss", "has_aliquota_iss"),
        _has("codigo_servico_municipal", "has_codigo_municipal"),
        _has("tributacao", "has_tributacao"),
    )


def dim_vendedores(stg: DataFrame, as_of: datetime) -> DataFrame:
    return _plain(stg, as_of, "vendedor_id", "vendedor_nome")

"""Whole-table audits of registration numbers and addresses."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.plans.dims import with_document_check
from ledgerlake.plans.staging import stg_pessoa_enderecos


def audit_documents(people: DataFrame) -> tuple[DataFrame, DataFrame]:
    """People with ``documento_is_valid``, and counts of valid, invalid, unjudged and absent by kind."""
    judged = with_document_check(people)
    ok = F.col("documento_is_valid")
    present = F.col("documento").isNotNull()
    summary = judged.groupBy(F.coalesce("tipo_pessoa", F.lit("desconhecido")).alias("tipo_pessoa")).agg(
        F.count(F.lit(1)).alias("pessoas"),
        F.count_if(F.coalesce(ok, F.lit(False))).alias("validos"),
        F.count_if(F.coalesce(~ok, F.lit(False))).alias("invalidos"),
        F.count_if(present & ok.isNull()).alias("nao_avaliados"),
        F.count_if(~present).alias("ausentes"),
    )
    return judged, summary


def clean_addresses(people_detail: DataFrame, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """One row per address with a normalised postal code, and counts of bad and absent codes by state."""
    addresses = stg_pessoa_enderecos(people_detail, as_of)
    given = F.col("cep").isNotNull()
    summary = addresses.groupBy(F.coalesce("estado", F.lit("desconhecido")).alias("estado")).agg(
        F.count(F.lit(1)).alias("enderecos"),
        F.count_if(given & F.col("cep_normalizado").isNull()).alias("cep_invalido"),
        F.count_if(~given).alias("cep_ausente"),
    )
    return addresses, summary

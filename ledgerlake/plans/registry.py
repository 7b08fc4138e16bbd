"""The models of the three layers: what they read, how they are stored, what is checked on them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from ledgerlake.operators.quality import Check, accepted, not_null, singleton, unique
from ledgerlake.plans import dims, facts, marts, staging, statement


@dataclass(frozen=True)
class Model:
    """``inputs`` are raw entities (``raw:name``) or models; ``dated`` builders take ``as_of`` last."""

    name: str
    layer: str
    build: Callable
    inputs: tuple[str, ...]
    mode: str = "table"
    key: str | None = None
    checks: tuple[Check, ...] = ()
    dated: bool = True
    drop_first: bool = False


def _required(*names: str) -> tuple[Check, ...]:
    return tuple(not_null(n) for n in names)


def _key(name: str) -> tuple[Check, ...]:
    return (not_null(name), unique(name))


ON_OFF = accepted("status", ("ativo", "inativo"), where="status is not null")
KIND = accepted("tipo_pessoa", ("pf", "pj"), where="tipo_pessoa is not null")
ONE_CATEGORY = accepted("num_categorias", (0, 1), severity="warn")
SERVICE = accepted("tipo_servico", ("prestado", "tomado"), where="tipo_servico is not null")

# entity → (key, mode, further checks)
_STAGING: dict[str, tuple[str | None, str, tuple[Check, ...]]] = {
    "baixas": ("baixa_id", "incremental", ()),
    "categorias_dre": (
        "categoria_dre_id",
        "view",
        (not_null("categoria_nome", "warn"), not_null("indica_totalizador")),
    ),
    "categorias_financeiras": (
        "categoria_id",
        "view",
        (
            not_null("categoria_nome"),
            accepted("tipo", ("RECEITA", "DESPESA"), where="tipo is not null"),
        ),
    ),
    "centros_de_custo": ("centro_de_custo_id", "view", _required("centro_de_custo_nome")),
    "cobrancas": ("cobranca_id", "incremental", ()),
    "conta_conectada": ("pk", "view", (singleton("pk"),)),
    "contas_a_pagar": ("evento_id", "incremental", (ONE_CATEGORY,)),
    "contas_a_receber": ("evento_id", "incremental", (ONE_CATEGORY,)),
    "contas_financeiras": ("conta_financeira_id", "view", _required("conta_nome")),
    "contratos": ("contrato_id", "view", ()),
    "contratos_detalhe": ("contrato_id", "view", ()),
    "eventos_alteracoes": ("evento_id", "incremental", ()),
    "notas_fiscais": (
        "nota_id",
        "view",
        (accepted("status", ("EMITIDA", "CORRIGIDA_SUCESSO"), where="status is not null"),),
    ),
    "notas_fiscais_itens": ("nota_item_id", "incremental", ()),
    "notas_servico": ("nota_id", "view", ()),
    "parcelas_detalhe": ("parcela_id", "incremental", ()),
    "pessoas": ("pessoa_id", "incremental", (not_null("pessoa_nome"), KIND)),
    "pessoas_detalhe": ("pessoa_id", "view", (not_null("pessoa_nome"), KIND)),
    "produto_categorias": ("categoria_id", "view", (not_null("categoria_nome", "warn"),)),
    "produto_cest": ("cest_codigo", "view", ()),
    "produto_ecommerce_marcas": ("marca_ecom_id", "view", ()),
    "produto_ncm": ("ncm_codigo", "view", ()),
    "produto_unidades_medida": ("unidade_id", "view", ()),
    "produtos": ("produto_id", "incremental", (ON_OFF,)),
    "produtos_detalhe": ("produto_id", "incremental", ()),
    "saldo_atual": ("saldo_atual_id", "incremental", ()),
    "saldo_inicial": ("saldo_id", "view", ()),
    "servicos": ("servico_id", "incremental", (ON_OFF, SERVICE)),
    "servicos_detalhe": ("servico_id", "incremental", ()),
    "transferencias": ("transferencia_id", "incremental", ()),
    "vendas": ("venda_id", "incremental", ()),
    "vendas_detalhe": ("venda_id", "incremental", ()),
    "vendas_itens": ("venda_item_id", "incremental", ()),
    "vendedores": ("vendedor_id", "view", _required("vendedor_nome")),
}

# model → (inputs, key, columns that must be filled, further checks)
_CURATED: dict[str, tuple[tuple[str, ...], str, tuple[str, ...], tuple[Check, ...]]] = {
    "dim_categorias_dre": (("categorias_dre",), "categoria_dre_id", ("is_raiz", "is_folha"), ()),
    "dim_categorias_financeiras": (
        ("categorias_financeiras",),
        "categoria_id",
        ("categoria_nome", "is_raiz", "is_folha"),
        (),
    ),
    "dim_centros_de_custo": (("centros_de_custo",), "centro_de_custo_id", (), ()),
    "dim_conta_conectada": (("conta_conectada",), "pk", ("has_documento", "has_email"), ()),
    "dim_contas_financeiras": (
        ("contas_financeiras",),
        "conta_financeira_id",
        (),
        (accepted("natureza", ("banco", "caixa", "cartao", "outro")),),
    ),
    "dim_contratos": (
        ("contratos", "contratos_detalhe"),
        "contrato_id",
        ("is_ativo", "has_detalhe", "is_recorrente"),
        (),
    ),
    "dim_pessoas": (("pessoas",), "pessoa_id", ("pessoa_nome", "has_email"), (KIND,)),
    "dim_produto_categorias": (("produto_categorias",), "categoria_id", (), ()),
    "dim_produto_cest": (("produto_cest",), "cest_codigo", (), ()),
    "dim_produto_ecommerce_marcas": (("produto_ecommerce_marcas",), "marca_ecom_id", (), ()),
    "dim_produto_ncm": (("produto_ncm",), "ncm_codigo", (), ()),
    "dim_produto_unidades_medida": (("produto_unidades_medida",), "unidade_id", (), ()),
    "dim_produtos": (
        ("produtos", "produtos_detalhe"),
        "produto_id",
        ("abaixo_estoque_minimo", "has_ncm", "has_tributacao", "has_fotos"),
        (),
    ),
    "dim_servicos": (
        ("servicos", "servicos_detalhe"),
        "servico_id",
        ("has_aliquota_iss", "has_codigo_municipal", "has_tributacao"),
        (),
    ),
    "dim_vendedores": (("vendedores",), "vendedor_id", ("vendedor_nome",), ()),
    "fct_baixas": (("baixas",), "baixa_id", ("tem_juros", "tem_multa"), ()),
    "fct_cobrancas": (("cobrancas",), "cobranca_id", ("is_quitada", "is_registrada"), ()),
    "fct_contas_a_pagar": (
        ("contas_a_pagar",),
        "evento_id",
        ("is_pago", "is_pendente", "is_atrasado"),
        (),
    ),
    "fct_contas_a_receber": (
        ("contas_a_receber",),
        "evento_id",
        ("is_pago", "is_pendente", "is_atrasado"),
        (),
    ),
    "fct_eventos_alteracoes": (("eventos_alteracoes",), "evento_id", (), ()),
    "fct_notas_fiscais": (("notas_fiscais",), "nota_id", ("is_emitida",), ()),
    "fct_notas_fiscais_itens": (("notas_fiscais_itens",), "nota_item_id", ("has_produto",), ()),
    "fct_notas_servico": (
        ("notas_servico",),
        "nota_id",
        ("is_emitida", "is_cancelada", "is_falha", "is_em_curso"),
        (),
    ),
    "fct_parcelas": (
        ("parcelas_detalhe",),
        "parcela_id",
        ("is_paga", "is_aberta", "is_cancelada", "is_atrasada"),
        (),
    ),
    "fct_saldo_atual": (("saldo_atual",), "saldo_atual_id", ("is_negativo", "is_zerado"), ()),
    "fct_saldo_inicial": (("saldo_inicial",), "saldo_id", (), ()),
    "fct_transferencias": (("transferencias",), "transferencia_id", ("has_origem", "has_destino"), ()),
    "fct_vendas": (
        ("vendas",),
        "venda_id",
        ("is_aprovada", "is_cancelada", "is_esperando_aprovacao", "has_detalhe"),
        (),
    ),
    "fct_vendas_itens": (("vendas_itens",), "venda_item_id", ("is_produto", "is_servico"), ()),
}

_MARTS = [
    Model("clientes_resumo", "delivery", marts.clientes_resumo, ("dim_pessoas",)),
    Model(
        "dre_estrutura",
        "delivery",
        statement.dre_estrutura,
        ("raw:categorias_dre", "dim_categorias_financeiras"),
        "view",
        dated=False,
    ),
    Model(
        "dre_valores",
        "delivery",
        statement.dre_valores,
        ("fct_contas_a_receber", "fct_contas_a_pagar"),
        "view",
        dated=False,
        drop_first=True,
    ),
    Model(
        "fin_despesa_diaria", "delivery", marts.fin_despesa_diaria, ("fct_contas_a_pagar",), "view", dated=False
    ),
    Model(
        "fin_receita_diaria", "delivery", marts.fin_receita_diaria, ("fct_contas_a_receber",), "view", dated=False
    ),
    Model("saldo_inicial", "delivery", marts.saldo_inicial, ("fct_saldo_inicial",), "view", dated=False),
    Model("vendas_diaria", "delivery", marts.vendas_diaria, ("fct_vendas",), "view", dated=False),
]


def _models() -> dict[str, Model]:
    found: list[Model] = []
    for entity, (key, mode, checks) in _STAGING.items():
        name = f"stg_{entity}"
        found.append(
            Model(
                name,
                "staging",
                getattr(staging, name),
                (f"raw:{entity}",),
                mode,
                key if mode == "incremental" else None,
                (*_key(key), *checks, not_null("staged_at")),
            )
        )
    found.append(
        Model(
            "stg_pessoa_enderecos",
            "staging",
            staging.stg_pessoa_enderecos,
            ("raw:pessoas_detalhe",),
            "view",
            checks=_required("pessoa_id", "endereco_seq", "staged_at"),
        )
    )
    for name, (inputs, key, filled, checks) in _CURATED.items():
        module = dims if name.startswith("dim_") else facts
        stamp = "dim_refreshed_at" if name.startswith("dim_") else "fct_refreshed_at"
        found.append(
            Model(
                name,
                "curated",
                getattr(module, name),
                tuple(f"stg_{i}" for i in inputs),
                checks=(*_key(key), *_required(*filled, stamp), *checks),
            )
        )
    return {m.name: m for m in found + _MARTS}


MODELS: dict[str, Model] = _models()

"""What the source system delivers: one declaration per entity.

Names and types are fixed by the source records; an entity adds its key, the columns an update must
not touch, how its rows are loaded and where its ids come from.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Spark type of each field kind: (as parsed from JSON, as stored in the raw table).
KINDS = {
    "uuid": ("string", "string"),
    "text": ("string", "string"),
    "clean": ("string", "string"),
    "enum": ("string", "string"),
    "money": ("decimal(18,4)", "decimal(18,4)"),
    "int": ("int", "int"),
    "long": ("bigint", "bigint"),
    "bool": ("boolean", "boolean"),
    "date": ("string", "date"),
    "ts": ("string", "timestamp"),
    "bag": ("string", "string"),
    "names": ("array<string>", "array<string>"),
    "party": ("struct<id:string,nome:string,email:string>",) * 2,
    "refs": ("array<struct<id:string,nome:string>>",) * 2,
    "addresses": (
        "array<struct<cep:string,logradouro:string,numero:string,complemento:string,bairro:string,"
        "cidade:string,id_cidade:int,estado:string,pais:string>>",
    )
    * 2,
    "subitems": (
        "array<struct<descricao:string,codigo:string,"
        "categorias_financeiras:array<struct<id:string,nome:string>>>>",
    )
    * 2,
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    aliases: tuple[str, ...] = ()
    required: bool = False


@dataclass(frozen=True)
class Entity:
    """``load``: full, incremental, window, chunks, parents, children, snapshot, changes or scan."""

    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...] = ("id",)
    insert_only: tuple[str, ...] = ()
    load: str = "full"
    days: int = 0
    date_column: str | None = None
    parents: tuple[str, ...] = ()
    parent_key: str | None = None
    newest_first: bool | None = None
    keep_raw: bool = True
    options: dict = field(default_factory=dict, hash=False)

    @property
    def parsed_schema(self) -> str:
        names: dict[str, str] = {}
        for f in self.fields:
            for name in (f.name, *f.aliases):
                names[name] = KINDS[f.kind][0]
        return ", ".join(f"`{n}` {kind}" for n, kind in names.items())

    @property
    def columns(self) -> dict[str, str]:
        out = {f.name: KINDS[f.kind][1] for f in self.fields}
        if self.keep_raw:
            out["raw"] = "string"
        out["loaded_at"] = "timestamp"
        return out

    @property
    def watermarked(self) -> bool:
        return self.load in ("incremental", "parents", "changes", "scan") or bool(
            self.options.get("watermark")
        )


def _all(kind: str, *names: str, required: bool = False) -> tuple[Field, ...]:
    return tuple(Field(n, kind, required=required) for n in names)


def _id(kind: str = "uuid", name: str = "id") -> tuple[Field, ...]:
    return (Field(name, kind, required=True),)


def _times(required: bool = False) -> tuple[Field, ...]:
    return _all("ts", "data_criacao", "data_alteracao", required=required)


def _title(party: str) -> tuple[Field, ...]:
    return (
        _id()
        + _all("clean", "status", "status_traduzido")
        + _all("money", "total", "nao_pago", "pago")
        + _all("clean", "descricao")
        + _all("ts", "data_vencimento", "data_competencia")
        + _times()
        + _all("refs", "categorias", "centros_de_custo")
        + _all("party", party)
        + _all("bag", "renegociacao")
    )


FIVE_YEARS = 5 * 365
CREATED = ("data_criacao",)
NAMED = (Field("nome", "text", required=True),)

_ENTITIES = [
    # people and account holder
    Entity(
        "pessoas",
        _id()
        + NAMED
        + _all("clean", "email", "documento")
        + _all("text", "tipo_pessoa")
        + _all("clean", "telefone")
        + _all("bool", "ativo")
        + _all("long", "id_legado")
        + _all("uuid", "uuid_legado")
        + _all("names", "perfis")
        + _times(required=True),
        insert_only=CREATED,
        load="incremental",
        keep_raw=False,
        options={"zero_is_null": ("id_legado", "uuid_legado")},
    ),
    Entity(
        "pessoas_detalhe",
        _id()
        + NAMED
        + _all("clean", "documento", "email", "telefone_comercial", "telefone_celular")
        + _all("text", "tipo_pessoa")
        + _all("clean", "nome_empresa", "rg")
        + _all("text", "data_nascimento")
        + _all("bool", "optante_simples_nacional", "orgao_publico")
        + _all("clean", "observacao", "codigo")
        + _all("bool", "ativo")
        + _all("addresses", "enderecos")
        + _all("bag", "outros_contatos", "inscricoes", "pessoas_legado", "perfis"),
        load="parents",
        parents=("pessoas",),
        newest_first=False,
        options={"high_water": "parent"},
    ),
    Entity(
        "conta_conectada",
        _all("clean", "documento", "razao_social", "nome_fantasia", "email", "data_fundacao"),
        keys=("pk",),
        options={"singleton": "pk", "shape": "single"},
    ),
    Entity("vendedores", _id() + NAMED, keep_raw=False, options={"shape": "list"}),
    # catalogue
    Entity(
        "produtos",
        _id()
        + _all("clean", "nome", "codigo", "descricao")
        + _all("money", "preco", "custo", "estoque", "estoque_minimo")
        + _all("clean", "unidade")
        + _all("text", "status")
        + _times(),
        insert_only=CREATED,
        load="incremental",
        keep_raw=False,
    ),
    Entity(
        "produtos_detalhe",
        _id()
        + _all("clean", "nome", "codigo", "descricao")
        + _all("money", "preco", "custo", "estoque", "estoque_minimo")
        + _all("clean", "ncm", "cest", "unidade")
        + _all("money", "peso", "altura", "largura", "comprimento")
        + _all("bag", "tributacao", "fotos")
        + _all("text", "status")
        + _times(),
        insert_only=CREATED,
        load="parents",
        parents=("produtos",),
        newest_first=False,
    ),
    Entity("produto_categorias", _id("long") + _all("clean", "nome", "descricao") + _all("bool", "ativo")),
    Entity("produto_ncm", _id("text", "codigo") + _all("clean", "descricao"), keys=("codigo",)),
    Entity(
        "produto_cest",
        _id("text", "codigo") + _all("clean", "descricao", "ncm_relacionado"),
        keys=("codigo",),
    ),
    Entity(
        "produto_unidades_medida",
        _id("long") + _all("clean", "sigla", "descricao") + _all("bool", "fracionavel"),
    ),
    Entity("produto_ecommerce_marcas", _id() + NAMED),
    Entity(
        "servicos",
        _id()
        + _all("long", "id_servico")
        + _all("clean", "nome", "codigo", "descricao")
        + _all("money", "preco", "custo")
        + _all("text", "status", "tipo_servico"),
        keep_raw=False,
        options={"pages_repeat": True},
    ),
    Entity(
        "servicos_detalhe",
        _id()
        + _all("clean", "nome", "codigo", "descricao")
        + _all("money", "preco", "custo", "aliquota_iss")
        + _all("clean", "codigo_servico_municipal")
        + _all("bag", "tributacao")
        + _all("clean", "observacao")
        + _all("text", "status", "tipo_servico")
        + _times(),
        insert_only=CREATED,
        load="children",
        parents=("servicos",),
    ),
    # finance: master data
    Entity(
        "categorias_financeiras",
        _id()
        + NAMED
        + _all("text", "tipo")
        + _all("uuid", "categoria_pai")
        + _all("text", "entrada_dre")
        + _all("bool", "considera_custo_dre")
        + _all("int", "versao"),
        keep_raw=False,
    ),
    Entity(
        "categorias_dre",
        _id()
        + _all("clean", "descricao", "codigo")
        + _all("int", "posicao")
        + _all("bool", "indica_totalizador", "representa_soma_custo_medio")
        + _all("subitems", "subitens")
        + _all("refs", "categorias_financeiras"),
    ),
    Entity(
        "centros_de_custo",
        _id() + NAMED + _all("clean", "descricao") + _all("bool", "ativo"),
        keep_raw=False,
    ),
    Entity(
        "contas_financeiras",
        _id()
        + NAMED
        + _all("text", "tipo", "banco")
        + _all("int", "codigo_banco")
        + _all("clean", "agencia", "numero")
        + _all("bool", "ativo", "conta_padrao", "possui_config_boleto_bancario"),
        keep_raw=False,
    ),
    # finance: movements
    Entity(
        "contas_a_receber",
        _title("cliente"),
        insert_only=CREATED,
        load="window",
        days=FIVE_YEARS,
        date_column="data_vencimento",
        options={"watermark": True},
    ),
    Entity(
        "contas_a_pagar",
        _title("fornecedor"),
        insert_only=CREATED,
        load="window",
        days=FIVE_YEARS,
        date_column="data_vencimento",
        options={"watermark": True},
    ),
    Entity(
        "transferencias",
        _id()
        + _all("ts", "data_transferencia")
        + _all("money", "valor")
        + _all("clean", "descricao")
        + _all("uuid", "conta_origem_id", "conta_destino_id")
        + _all("party", "conta_origem", "conta_destino")
        + _times(),
        insert_only=CREATED,
        load="chunks",
        days=365,
        date_column="data_transferencia",
        options={
            "look_back": FIVE_YEARS,
            "ids": {"conta_origem_id": "conta_origem.id", "conta_destino_id": "conta_destino.id"},
        },
    ),
    Entity(
        "saldo_inicial",
        (
            Field("id", "uuid"),
            Field("conta_financeira_id", "uuid", ("id_conta_financeira",)),
            Field("data_referencia", "ts", ("data_competencia",)),
        )
        + _all("money", "saldo", "saldo_inicial")
        + _all("party", "conta_financeira"),
        load="window",
        days=365,
        date_column="data_referencia",
        options={
            "ids": {"conta_financeira_id": "conta_financeira.id"},
            "generated_id": "opening_balance",
        },
    ),
    Entity(
        "saldo_atual",
        (Field("id", "uuid"),)
        + _all("uuid", "conta_financeira_id")
        + _all("money", "saldo_atual", "saldo")
        + _all("date", "snapshot_date")
        + _all("ts", "data_snapshot"),
        insert_only=("conta_financeira_id", "snapshot_date"),
        load="snapshot",
        parents=("contas_financeiras",),
    ),
    Entity(
        "eventos_alteracoes",
        _id() + _all("ts", "data_alteracao") + _all("text", "tipo_evento"),
        load="changes",
        days=30,
        date_column="data_alteracao",
    ),
    Entity(
        "parcelas_detalhe",
        _id()
        + _all("uuid", "evento_financeiro_id")
        + _all("int", "numero_parcela")
        + _all("money", "valor", "valor_bruto", "valor_liquido", "desconto", "juros", "multa")
        + _all("ts", "data_vencimento", "data_pagamento")
        + _all("clean", "status", "forma_pagamento")
        + _all("uuid", "conta_financeira_id")
        + _all("party", "conta_financeira")
        + _times(),
        insert_only=CREATED,
        load="parents",
        parents=("contas_a_receber", "contas_a_pagar"),
        parent_key="evento_financeiro_id",
        newest_first=False,
    ),
    Entity(
        "baixas",
        _id()
        + _all("uuid", "parcela_id")
        + _all("ts", "data_pagamento")
        + _all("money", "valor", "juros", "multa", "desconto")
        + _all("clean", "metodo_pagamento", "forma_pagamento")
        + _all("uuid", "conta_financeira_id")
        + _all("party", "conta_financeira")
        + _all("clean", "observacao")
        + _times(),
        insert_only=CREATED,
        load="parents",
        parents=("parcelas_detalhe",),
        parent_key="parcela_id",
        newest_first=False,
    ),
    Entity(
        "cobrancas",
        _id()
        + _all("uuid", "parcela_id", "evento_financeiro_id")
        + _all("clean", "status", "url")
        + _all("money", "valor")
        + _all("clean", "tipo")
        + _all("ts", "data_vencimento", "data_emissao", "data_alteracao"),
        load="scan",
        parents=("parcelas_detalhe", "contas_a_receber"),
    ),
    # sales and contracts
    Entity(
        "vendas",
        _id()
        + _all("long", "numero")
        + _all("enum", "situacao", "tipo")
        + (Field("tipo_item", "text", ("itens",)), Field("origem", "enum"))
        + _all("bool", "pendente", "condicao_pagamento")
        + _all("int", "versao")
        + _all("money", "total", "desconto")
        + (Field("data_venda", "date", ("data",)),)
        + _all("ts", "criado_em", "data_alteracao")
        + _all("clean", "observacoes")
        + _all("party", "cliente", "vendedor")
        + _all("bag", "natureza_operacao", "categoria", "pagamento")
        + _all("long", "id_legado", "id_legado_cliente", "id_legado_dono"),
        insert_only=("criado_em",),
        load="incremental",
    ),
    Entity(
        "vendas_detalhe",
        _id()
        + _all("long", "numero")
        + _all("clean", "situacao")
        + _all("ts", "data_emissao", "data_alteracao")
        + _all("money", "valor_bruto", "valor_desconto", "valor_frete", "valor_impostos", "valor_liquido")
        + _all("clean", "observacoes")
        + _all("party", "cliente", "vendedor", "natureza_operacao")
        + _all("bag", "condicao_pagamento", "parcelas", "endereco_entrega"),
        load="parents",
        parents=("vendas",),
        newest_first=False,
    ),
    Entity(
        "vendas_itens",
        (Field("id", "uuid"),)
        + _all("uuid", "venda_id", "produto_id", "servico_id")
        + _all("clean", "descricao", "codigo")
        + _all("money", "quantidade", "valor_unitario", "desconto", "valor_total")
        + _all("clean", "cfop", "ncm", "unidade"),
        load="children",
        parents=("vendas",),
        parent_key="venda_id",
        newest_first=True,
        options={"generated_id": "sale_item", "numbers": ("numero_item",)},
    ),
    Entity(
        "contratos",
        _id()
        + _all("clean", "numero", "descricao")
        + _all("uuid", "cliente_id")
        + _all("money", "valor")
        + _all("ts", "data_inicio", "data_fim")
        + _all("text", "status")
        + _times(),
        insert_only=CREATED,
        load="window",
        days=FIVE_YEARS,
        date_column="data_inicio",
    ),
    Entity(
        "contratos_detalhe",
        _id()
        + _all("clean", "numero", "descricao")
        + _all("party", "cliente", "vendedor")
        + _all("bag", "composicao_de_valor", "condicao_pagamento", "configuracao_recorrencia", "termos")
        + _all("ts", "data_emissao", "data_inicio", "data_fim")
        + _all("clean", "status")
        + _all("money", "valor_bruto", "valor_liquido")
        + _times(),
        insert_only=CREATED,
        load="parents",
        parents=("contratos",),
        newest_first=False,
    ),
    # invoices
    Entity(
        "notas_fiscais",
        _id()
        + _all("clean", "numero")
        + _all("text", "status")
        + _all("money", "valor")
        + _all("ts", "data_emissao")
        + _all("clean", "chave_acesso", "serie")
        + _all("uuid", "venda_id", "cliente_id")
        + _all("clean", "documento_tomador"),
        load="chunks",
        days=15,
        date_column="data_emissao",
        options={"look_back": 365},
    ),
    Entity(
        "notas_fiscais_itens",
        (Field("id", "text"),)
        + _all("uuid", "nota_fiscal_id")
        + _all("clean", "chave_acesso")
        + _all("int", "numero_item")
        + _all("uuid", "produto_id")
        + _all("clean", "codigo", "descricao", "ncm", "cfop")
        + _all("money", "quantidade", "valor_unitario", "valor_total")
        + _all("money", "valor_icms", "valor_ipi", "valor_pis", "valor_cofins"),
        load="children",
        parents=("notas_fiscais",),
        parent_key="chave_acesso",
        newest_first=True,
        options={
            "generated_id": "invoice_item",
            "numbers": ("numero_item", "numero"),
            "parent_wins": ("nota_fiscal_id",),
            "parent_id": "chave_acesso",
            "parent_columns": {"nota_fiscal_id": "id"},
            "item_keys": ("itens", "produtos"),
        },
    ),
    Entity(
        "notas_servico",
        _id()
        + _all("clean", "numero")
        + _all("text", "status")
        + _all("money", "valor")
        + _all("ts", "data_emissao", "data_competencia")
        + _all("uuid", "cliente_id"),
        load="chunks",
        days=15,
        date_column="data_emissao",
        options={"look_back": 365},
    ),
    # demonstration rows
    Entity(
        "customers",
        _id("long") + (Field("name", "text", required=True), Field("ingested_at", "ts", required=True)),
        keep_raw=False,
    ),
]

ENTITIES: dict[str, Entity] = {e.name: e for e in _ENTITIES}

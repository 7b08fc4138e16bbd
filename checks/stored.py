"""Queries that go through stored tables: loads, keyed merges and the three ways to store a model."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.mapping import RAW, load, raw_cte, raw_table, uid
from checks.models import AS_OF, ORACLE as MODEL_ORACLE, Query, plain
from checks.operations import ITEM_JSON, ORACLE as OPERATION_ORACLE
from ledgerlake.functions.time import instant
from ledgerlake.operators.watermark import incremental_slice
from ledgerlake.plans import facts, jobs, loads, marts, staging
from ledgerlake.session import shared_dir
from ledgerlake.sources import tables
from ledgerlake.sources.entities import ENTITIES
from ledgerlake.sources.pages import complete_endpoints, unwrap_pages


def _tenant(spark: SparkSession) -> str:
    """A tenant of its own, with its databases below the shared folder."""
    tenant = f"q{uuid.uuid4().hex[:10]}"
    root = shared_dir(spark, tenant)
    for layer in tables.LAYERS:
        tables.ensure_database(spark, tenant, layer, root)
    return tenant


def q_load_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed items parsed, checked, merged into the raw table; unusable ones are set aside."""
    tenant = _tenant(spark)
    items = load(spark, sf_dir, "orders").selectExpr(f"{ITEM_JSON} as item", "o_orderkey as position")
    loads.load_entity(spark, tenant, "vendas", items, AS_OF, buckets=8)
    return plain(
        tables.source(spark, tenant, "vendas").select(
            "id", "numero", "situacao", "tipo", "tipo_item", "total", "data_venda", "criado_em",
            F.col("cliente.id").alias("cliente_id"), "categoria",
            (F.get_json_object("raw", "$.novo_campo") == "[1,2]").alias("raw_kept"),
        )
    )


def q_raw_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a raw table that got rows past the load: repeated keys without a load time, and rows without a key."""
    tenant = _tenant(spark)
    items = load(spark, sf_dir, "orders").selectExpr(f"{_sale('o_totalprice')} as item", "o_orderkey as position")
    loads.load_entity(spark, tenant, "vendas", items, AS_OF, buckets=8)
    table = tables.table_name(tenant, "raw", "vendas")
    rows = tables.read(spark, table)
    number = F.col("numero").cast("bigint")
    again = rows.where(number % 7 == 0).withColumn("loaded_at", F.lit(None).cast("timestamp"))
    nameless = rows.where(number % 11 == 0).withColumn("id", F.lit(None).cast("string"))
    again.unionByName(nameless).write.parquet(landed := shared_dir(spark, "past-the-load"))
    both = tables.read(spark, table).unionByName(spark.read.parquet(landed))
    both.write.parquet(whole := shared_dir(spark, "raw-rows"))
    spark.sql(f"DROP TABLE {table}")
    tables.materialize(spark.read.parquet(whole), table)
    return plain(loads.check_raw(spark, tenant, ["vendas"])).where("check_name in ('not_null_id', 'unique_id', 'not_null_loaded_at')")


def _sale(total: str) -> str:
    """A sale of an order as JSON, with the given total."""
    return (
        f"concat('{{\"id\":\"', {uid('1a000000', 'o_orderkey')}, '\",\"numero\":', cast(o_orderkey as string), "
        f"',\"total\":', cast({total} as string), ',\"data\":\"', cast(cast(o_orderdate as date) as string), '\"}}')"
    )


def q_load_pages_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sale on three pages; the last page counts, wherever on its page a record stands."""
    tenant = _tenant(spark)
    orders = load(spark, sf_dir, "orders")
    pages = [
        orders.selectExpr(f"{_sale(f'o_orderkey + {page}')} as item", f"'page-{page}' as source_file", f"{9 - page} as position")
        for page in (1, 2, 3)
    ]
    loads.load_entity(spark, tenant, "vendas", pages[2].unionByName(pages[0]).unionByName(pages[1]), AS_OF, buckets=8)
    return plain(tables.source(spark, tenant, "vendas").select("id", "numero", "total"))


def q_load_no_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one id without any order: one row per id, of the greatest values."""
    tenant = _tenant(spark)
    orders = load(spark, sf_dir, "orders")
    twice = orders.selectExpr(f"{_sale('o_orderkey')} as item").union(orders.selectExpr(f"{_sale('o_orderkey + 3')} as item"))
    loads.load_entity(spark, tenant, "vendas", twice, AS_OF, buckets=8)
    return plain(tables.source(spark, tenant, "vendas").select("id", "numero", "total"))


def q_load_children_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each order delivered on two pages: those of the second page stay, once each."""
    tenant = _tenant(spark)
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    item = "concat('{\"codigo\":\"', cast(l_linenumber as string), '\",\"quantidade\":', cast(l_linenumber + 100 * page as string), '}')"
    both = [
        lines.where(f"{page} = 1 or l_linenumber < 5")
        .withColumn("page", F.lit(page))
        .selectExpr(f"{item} as item", "page", "l_linenumber as position", f"{uid('1a000000', 'l_orderkey')} as venda_id")
        for page in (1, 2)
    ]
    loads.load_entity(spark, tenant, "vendas_itens", both[1].unionByName(both[0]), AS_OF, buckets=8)
    return plain(tables.source(spark, tenant, "vendas_itens").select("venda_id", "codigo", "quantidade"))


def q_load_saldo_atual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of two runs on one day and one on the next: a row per account and day, the later run of a day counts."""
    tenant = _tenant(spark)
    account = uid("33000000", "c_custkey")
    for now, amount in ((datetime(1998, 5, 31, 8), 1), (datetime(1998, 5, 31, 20), 2), (datetime(1998, 6, 1, 8), 3)):
        item = f"concat('{{\"conta_financeira_id\":\"', {account}, '\",\"saldo_atual\":', cast(c_custkey * {amount} as string), '}}')"
        loads.load_entity(spark, tenant, "saldo_atual", load(spark, sf_dir, "customer").selectExpr(f"{item} as item"), now, buckets=8)
    return plain(tables.source(spark, tenant, "saldo_atual").select("conta_financeira_id", "saldo_atual", "snapshot_date"))


def q_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table of titles; a second batch changes amounts and creation times, which must not change."""
    tenant = _tenant(spark)
    table = tables.table_name(tenant, "raw", "contas_a_receber")
    rows = raw_table(spark, sf_dir, "contas_a_receber").select("id", "status", "total", "data_criacao")
    tables.ensure_table(
        spark, table, {**dict(rows.dtypes), "loaded_at": "timestamp"}, ["id"], 8
    )
    tables.upsert_table(spark, table, rows, ["id"], loaded_at=AS_OF - timedelta(days=1))
    changed = rows.where("status = 'PENDING'").withColumns(
        {"total": F.col("total") + 1, "data_criacao": F.lit(None).cast("timestamp")}
    )
    tables.upsert_table(spark, table, changed, ["id"], insert_only=["data_criacao"], loaded_at=AS_OF)
    return plain(tables.read(spark, table))


def q_incremental_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging built in two incremental runs, a stored fact and a mart view on top."""
    tenant = _tenant(spark)
    raw = raw_table(spark, sf_dir, "contas_a_receber").withColumn("loaded_at", F.col("data_alteracao"))
    stage = tables.table_name(tenant, "staging", "stg_contas_a_receber")
    fact = tables.table_name(tenant, "curated", "fct_contas_a_receber")
    mart = tables.table_name(tenant, "delivery", "fin_receita_diaria")
    cut = datetime(1998, 1, 1)
    first = staging.stg_contas_a_receber(raw.where(F.col("loaded_at") <= instant(cut)), cut)
    tables.materialize(first, stage, "incremental", key="evento_id", buckets=8)
    rest = incremental_slice(raw, tables.read(spark, stage))
    tables.materialize(
        staging.stg_contas_a_receber(rest, AS_OF), stage, "incremental", key="evento_id", buckets=8
    )
    tables.materialize(
        facts.fct_contas_a_receber(tables.ref(spark, stage), AS_OF), fact, "table", drop_first=True
    )
    tables.materialize(marts.fin_receita_diaria(tables.ref(spark, fact)), mart, "view", drop_first=True)
    return plain(tables.ref(spark, mart))


def q_table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in two batches; the second is merged twice, with a compaction between: one row per key, first creation times."""
    tenant = _tenant(spark)
    table = tables.table_name(tenant, "raw", "baixas")
    rows = raw_table(spark, sf_dir, "baixas").select("id", "valor", "data_criacao")
    tables.ensure_table(spark, table, {**dict(rows.dtypes), "loaded_at": "timestamp"}, ["id"])
    tables.upsert_table(spark, table, rows, ["id"], insert_only=["data_criacao"], loaded_at=AS_OF - timedelta(days=1))
    changed = rows.where("valor > 20000").withColumns({"valor": F.col("valor") + 1, "data_criacao": F.lit(None).cast("timestamp")})
    for turn in range(2):
        tables.upsert_table(spark, table, changed, ["id"], insert_only=["data_criacao"], loaded_at=AS_OF)
        if not turn:
            tables.compact_table(spark, table)
    return plain(tables.read(spark, table))


def _landed(spark: SparkSession, sf_dir: str, table: str, parent: str, **fields: str) -> DataFrame:
    """Details of every row as landed records, with the key they were asked for."""
    struct = ", ".join(f"'{name}', {value}" for name, value in fields.items())
    return load(spark, sf_dir, table).selectExpr(f"to_json(named_struct({struct})) as item", f"{parent} as parent_id")


def _parents(spark: SparkSession, sf_dir: str, tenant: str, name: str, table: str, key: str, changed: str, where: str = "true") -> None:
    items = load(spark, sf_dir, table).where(where).selectExpr(f"to_json(named_struct('id', {key}, 'data_alteracao', {changed})) as item")
    loads.load_entity(spark, tenant, name, items, LATE)


LATE = datetime(2003, 1, 1)
SALE, TITLE, BILL, PART = (lambda k, kind=kind: uid(kind, k) for kind in ("1a000000", "2a000000", "2b000000", "3a000000"))


def q_load_vendas_detalhe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of all sales, then again after a tenth of the sales changed: only theirs are taken."""
    tenant = _tenant(spark)
    _parents(spark, sf_dir, tenant, "vendas", "orders", SALE("o_orderkey"), "o_orderdate")
    for extra, where in ((0, "true"), (1, "o_orderkey % 10 = 0")):
        if extra:
            _parents(spark, sf_dir, tenant, "vendas", "orders", SALE("o_orderkey"), "timestamp '2002-06-01 00:00:00'", where)
        details = _landed(spark, sf_dir, "orders", SALE("o_orderkey"), numero="o_orderkey", valor_bruto=f"cast(o_totalprice as decimal(18,2)) + {extra}")
        jobs.load_details(spark, tenant, "vendas_detalhe", details, LATE)
    return plain(tables.source(spark, tenant, "vendas_detalhe").select("id", "numero", "valor_bruto"))


def q_load_parcelas_detalhe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instalments of receivables and payables; later some payables change, and only their instalments are read again."""
    tenant = _tenant(spark)
    _parents(spark, sf_dir, tenant, "contas_a_receber", "orders", TITLE("o_orderkey"), "o_orderdate")
    _parents(spark, sf_dir, tenant, "contas_a_pagar", "supplier", BILL("s_suppkey"), "timestamp '1996-01-01 00:00:00'")

    def details(extra: int) -> DataFrame:
        ours = _landed(spark, sf_dir, "orders", TITLE("o_orderkey"), id=uid("3a000000", "o_orderkey"), valor=f"o_orderkey + {extra}")
        theirs = _landed(spark, sf_dir, "supplier", BILL("s_suppkey"), id=uid("3b000000", "s_suppkey"), valor=f"s_suppkey + {extra}")
        return ours.unionByName(theirs)

    jobs.load_details(spark, tenant, "parcelas_detalhe", details(0), LATE)
    _parents(spark, sf_dir, tenant, "contas_a_pagar", "supplier", BILL("s_suppkey"), "timestamp '2002-06-01 00:00:00'", "s_suppkey % 3 = 0")
    jobs.load_details(spark, tenant, "parcelas_detalhe", details(7), LATE)
    return plain(tables.source(spark, tenant, "parcelas_detalhe").select("id", "evento_financeiro_id", "valor"))


def q_load_baixas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with change times of their own, two years after their instalment's: the mark is theirs, so parents changed before it are not read again."""
    tenant = _tenant(spark)
    _parents(spark, sf_dir, tenant, "parcelas_detalhe", "orders", PART("o_orderkey"), "o_orderdate")

    def details(extra: int) -> DataFrame:
        when = "date_format(o_orderdate + interval 2 years, \"yyyy-MM-dd'T'HH:mm:ss\")"
        return _landed(spark, sf_dir, "orders", PART("o_orderkey"), id=uid("4a000000", "o_orderkey"), valor=f"o_orderkey + {extra}", data_alteracao=when)

    jobs.load_details(spark, tenant, "baixas", details(0), LATE)
    _parents(spark, sf_dir, tenant, "parcelas_detalhe", "orders", PART("o_orderkey"), "timestamp '2002-06-01 00:00:00'", "o_orderkey % 4 = 0")
    _parents(spark, sf_dir, tenant, "parcelas_detalhe", "orders", PART("o_orderkey"), "timestamp '2020-06-01 00:00:00'", "o_orderkey % 4 = 1")
    jobs.load_details(spark, tenant, "baixas", details(7), LATE)
    return plain(tables.source(spark, tenant, "baixas").select("id", "parcela_id", "valor"))


def q_load_cobrancas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges that a record names, some at depth 100; charges that none names are not loaded."""
    tenant = _tenant(spark)
    charge = uid("5a000000", "o_orderkey")
    inner = f"concat('{{\"cobrancas\":[{{\"id\":\"', {charge}, '\"}}]}}')"
    deep = f"concat(repeat('{{\"a\":', 100), {inner}, repeat('}}', 100))"
    named = f"case when o_orderkey % 3 = 0 then {inner} when o_orderkey % 500 = 1 then {deep} else '{{}}' end"
    item = f"concat('{{\"id\":\"', {TITLE('o_orderkey')}, '\",\"x\":', {named}, '}}') as item"
    loads.load_entity(spark, tenant, "contas_a_receber", load(spark, sf_dir, "orders").selectExpr(item), LATE)
    jobs.load_charges(spark, tenant, _landed(spark, sf_dir, "orders", charge, valor="o_orderkey"), LATE)
    return plain(tables.source(spark, tenant, "cobrancas").select("id", "valor"))


def q_load_children_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of sales by id; those of every fifth sale then come under the sale before, which keeps none of its own."""
    tenant = _tenant(spark)
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    line = uid("7a000000", "l_orderkey * 10 + l_linenumber")

    def batch(where: str, sale: str) -> DataFrame:
        return lines.where(where).selectExpr(f"to_json(named_struct('id', {line}, 'codigo', cast(l_linenumber as string))) as item", f"{SALE(sale)} as venda_id")

    loads.load_entity(spark, tenant, "vendas_itens", batch("true", "l_orderkey"), AS_OF)
    loads.load_entity(spark, tenant, "vendas_itens", batch("l_orderkey % 5 = 0 and l_orderkey > 0", "l_orderkey - 1"), AS_OF)
    return plain(tables.source(spark, tenant, "vendas_itens").select("id", "venda_id", "codigo"))


def q_load_chunks_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers by years; the second chunk fails at first, and the rerun goes on there."""
    tenant, calls = _tenant(spark), []

    def fetch(first, last) -> DataFrame:
        calls.append(first)
        if len(calls) == 2:
            raise OSError("no answer")
        days = load(spark, sf_dir, "orders").where(F.col("o_orderdate").cast("date").between(F.lit(first), F.lit(last)))
        return days.selectExpr(f"to_json(named_struct('id', {uid('6a000000', 'o_orderkey')}, 'valor', o_orderkey, 'data_transferencia', o_orderdate)) as item", f"{len(calls)} as page")

    try:
        jobs.load_chunks(spark, tenant, "transferencias", fetch, LATE, "run")
    except OSError:
        jobs.load_chunks(spark, tenant, "transferencias", fetch, LATE, "run")
    return plain(tables.source(spark, tenant, "transferencias").select("id", "valor", "data_transferencia")).withColumn("calls", F.lit(len(calls)))


def q_load_pages_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoints that repeat their pages from the third on, and endpoints that fall short: cut at the repeat, held back when short."""
    tenant = _tenant(spark)
    pages_ = _endpoint_pages(spark, sf_dir)
    whole, _ = complete_endpoints(pages_)
    loads.load_entity(spark, tenant, "vendas", unwrap_pages(whole).drop("endpoint"), AS_OF)
    return plain(tables.source(spark, tenant, "vendas").select("id", "numero", "total"))


def _endpoint_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in endpoints of 40, two pages of 20; odd endpoints deliver them twice, and every seventh announces more than comes."""
    orders = load(spark, sf_dir, "orders")
    pages = (
        orders.selectExpr("o_orderkey div 40 as endpoint", "o_orderkey % 40 div 20 as page", f"{_sale('o_orderkey + 3')} as item")
        .groupBy("endpoint", "page")
        .agg(F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"), F.count(F.lit(1)).alias("n"))
    )
    totals = pages.groupBy("endpoint").agg(F.sum("n").alias("total"))
    said = "total + case when endpoint % 7 = 0 then 5 else 0 end"
    both = pages.join(totals, "endpoint").selectExpr("endpoint", "page", f"concat('{{\"itens_totais\":', cast({said} as string), ',\"itens\":[', items, ']}}') as body")
    return both.unionByName(both.where("endpoint % 2 = 1").withColumn("page", F.col("page") + 2))


def q_stream_load_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales of ``load_sales`` landed as page files, loaded by a stream in several micro-batches."""
    tenant = _tenant(spark)
    orders = load(spark, sf_dir, "orders").selectExpr(f"{ITEM_JSON} as item", "o_orderkey div 500 as page")
    good = orders.where("o_orderkey % 10 <> 9")  # a broken record would make its whole page unreadable
    pages = good.groupBy("page").agg(F.concat(F.lit('{"itens":['), F.array_join(F.collect_list("item"), ","), F.lit("]}")).alias("value"))
    pages.select("value").repartition(8).write.text(landed := shared_dir(spark, "landed-sales"), lineSep="\n")
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 3).load(landed)
    stream = lines.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("body"))
    jobs.stream_load(stream, tenant, "vendas", shared_dir(spark, "progress"), lambda: AS_OF).awaitTermination()
    return plain(
        tables.source(spark, tenant, "vendas").select(
            "id", "numero", "situacao", "tipo", "tipo_item", "total", "data_venda", "criado_em",
            F.col("cliente.id").alias("cliente_id"), "categoria",
            (F.get_json_object("raw", "$.novo_campo") == "[1,2]").alias("raw_kept"),
        )
    )


#: Kinds whose values a load takes as they are.
KEPT_KINDS = ("money", "int", "long", "bool", "ts", "date")
OWN_QUERY = ("vendas", "vendas_detalhe", "parcelas_detalhe", "baixas", "cobrancas", "saldo_atual")
PLAIN_LOADS = [name for name in RAW if name not in OWN_QUERY]


def _loaded_columns(name: str) -> list[str]:
    entity, mapped = ENTITIES[name], RAW[name].cols
    own = [f.name for f in entity.fields if f.name in mapped and f.kind in KEPT_KINDS]
    if entity.options.get("singleton"):
        return [entity.options["singleton"]]
    ids = [k for k in entity.keys if k in mapped and not entity.options.get("generated_id")]
    return [*ids, *[c for c in own if c not in ids]]


def _clock(name: str) -> datetime:
    """A run inside the time of the given rows, where the load has a window."""
    if name == "saldo_inicial":
        return AS_OF
    return datetime(1999, 1, 1) if ENTITIES[name].load in ("window", "chunks") else LATE


def _plain_load(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tenant, entity = _tenant(spark), ENTITIES[name]
        rows = raw_table(spark, sf_dir, name).drop("raw", "loaded_at")
        if entity.load == "children" and entity.parent_key:
            rows = rows.where(f"trim({entity.parent_key}) <> ''")
        items = rows.select(F.to_json(F.struct(*rows.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias("item"))
        loads.load_entity(spark, tenant, name, items, _clock(name))
        return plain(tables.source(spark, tenant, name).select(*_loaded_columns(name)))

    return run


def _plain_oracle(name: str) -> str:
    entity, columns = ENTITIES[name], _loaded_columns(name)
    kinds = {f.name: f.kind for f in entity.fields}
    cast = {"ts": "timestamp", "date": "date", "int": "int", "long": "bigint", "bool": "boolean", "money": "decimal(18,4)"}
    listed = ", ".join(f"cast({c} as {cast[kinds[c]]}) as {c}" if kinds.get(c) in cast else c for c in columns)
    days = entity.options.get("look_back", entity.days)
    scope = {"window": days, "chunks": days, "changes": days}.get(entity.load)
    day = f"cast({entity.date_column} as date)"
    where = f" where {entity.date_column} is null or {day} between date '{_clock(name).date()}' - {scope} and date '{_clock(name).date()}'" if scope else ""
    if entity.options.get("singleton"):
        return "select cast(1 as int) as pk"
    if entity.load == "children" and entity.parent_key:
        where = f" where trim({entity.parent_key}) <> ''"
    return f"with {raw_cte(name)} select {listed} from raw_{name}{where}"


_SALES = f"""select {uid('1a000000', 'o_orderkey')} as id, o_orderkey as numero, cast(o_orderkey + 3 as decimal(18,4)) as total
from orders"""
QUERIES: dict[str, Query] = {
    "load_sales": q_load_sales,
    "load_pages_latest": q_load_pages_latest,
    "load_no_order": q_load_no_order,
    "load_children_repeated": q_load_children_repeated,
    "load_saldo_atual": q_load_saldo_atual,
    "raw_checks": q_raw_checks,
    "table_upsert": q_table_upsert,
    "incremental_model": q_incremental_model,
    "table_rerun": q_table_rerun,
    "load_vendas_detalhe": q_load_vendas_detalhe,
    "load_parcelas_detalhe": q_load_parcelas_detalhe,
    "load_baixas": q_load_baixas,
    "load_cobrancas": q_load_cobrancas,
    "load_children_moved": q_load_children_moved,
    "load_chunks_resumed": q_load_chunks_resumed,
    "load_pages_repeated": q_load_pages_repeated,
    "stream_load_sales": q_stream_load_sales,
    **{f"load_{name}": _plain_load(name) for name in PLAIN_LOADS},
}
ORACLE: dict[str, str] = {
    "load_sales": OPERATION_ORACLE["parse_items"],
    "load_pages_latest": _SALES,
    "raw_checks": """with o as (select distinct o_orderkey as k from orders)
select 'vendas' as table_name, c.check_name, c.column_name, 'error' as severity, c.failures,
       case when c.failures = 0 then 'pass' else 'fail' end as status
from (select 'not_null_id' as check_name, 'id' as column_name, count(*) filter (k % 11 = 0) as failures from o
      union all select 'unique_id', 'id', count(*) filter (k % 7 = 0) from o
      union all select 'not_null_loaded_at', 'loaded_at', count(*) filter (k % 7 = 0) from o) c""",
    "load_no_order": _SALES,
    "load_children_repeated": f"""with lines as (select distinct l_orderkey, l_linenumber from lineitem),
late as (select distinct l_orderkey from lines where l_linenumber < 5)
select {uid('1a000000', 'l_orderkey')} as venda_id, cast(l_linenumber as string) as codigo,
       cast(l_linenumber + case when l_linenumber < 5 then 200 else 100 end as decimal(18,4)) as quantidade
from lines where l_linenumber < 5 or l_orderkey not in (select l_orderkey from late)""",
    "load_saldo_atual": f"""select {uid('33000000', 'c_custkey')} as conta_financeira_id,
       cast(c_custkey * n as decimal(18,4)) as saldo_atual, date '1998-05-30' + cast(n - 1 as int) as snapshot_date
from customer, (values (2), (3)) as runs(n)""",
    "table_upsert": f"""with {raw_cte('contas_a_receber')}
select id, status, cast(case when status = 'PENDING' then total + 1 else total end as decimal(18,4)) as total, data_criacao,
       case when status = 'PENDING' then timestamp '1998-06-01 00:00:00' else timestamp '1998-05-31 00:00:00' end as loaded_at
from raw_contas_a_receber""",
    "incremental_model": MODEL_ORACLE["fin_receita_diaria"],
    "table_rerun": f"""with {raw_cte('baixas')}
select id, cast(case when valor > 20000 then valor + 1 else valor end as decimal(18,4)) as valor, data_criacao,
       case when valor > 20000 then timestamp '1998-06-01 00:00:00' else timestamp '1998-05-31 00:00:00' end as loaded_at
from raw_baixas""",
    "load_vendas_detalhe": f"""select {SALE('o_orderkey')} as id, o_orderkey as numero,
       cast(cast(o_totalprice as decimal(18,2)) + case when o_orderkey % 10 = 0 then 1 else 0 end as decimal(18,4)) as valor_bruto from orders""",
    "load_parcelas_detalhe": f"""select {uid('3a000000', 'o_orderkey')} as id, {TITLE('o_orderkey')} as evento_financeiro_id,
       cast(o_orderkey as decimal(18,4)) as valor from orders
union all select {uid('3b000000', 's_suppkey')}, {BILL('s_suppkey')}, cast(s_suppkey + case when s_suppkey % 3 = 0 then 7 else 0 end as decimal(18,4))
from supplier""",
    "load_baixas": f"""select {uid('4a000000', 'o_orderkey')} as id, {PART('o_orderkey')} as parcela_id,
       cast(o_orderkey + case when o_orderkey % 4 = 1 then 7 else 0 end as decimal(18,4)) as valor from orders""",
    "load_cobrancas": f"""select {uid('5a000000', 'o_orderkey')} as id, cast(o_orderkey as decimal(18,4)) as valor
from orders where o_orderkey % 3 = 0 or o_orderkey % 500 = 1""",
    "load_children_moved": f"""with lines as (select distinct l_orderkey as k, l_linenumber as n from lineitem),
moved as (select k, n, case when k % 5 = 0 and k > 0 then k - 1 else k end as sale from lines)
select {uid('7a000000', 'k * 10 + n')} as id, {SALE('sale')} as venda_id, cast(n as string) as codigo
from moved where k % 5 = 0 or k + 1 not in (select k from lines where k % 5 = 0)""",
    "load_chunks_resumed": f"""select {uid('6a000000', 'o_orderkey')} as id, cast(o_orderkey as decimal(18,4)) as valor,
       o_orderdate as data_transferencia, cast(6 as int) as calls
from orders where cast(o_orderdate as date) >= date '2003-01-01' - 1825""",
    "load_pages_repeated": f"{_SALES} where (o_orderkey // 40) % 7 <> 0",
    "stream_load_sales": OPERATION_ORACLE["parse_items"],
    **{f"load_{name}": _plain_oracle(name) for name in PLAIN_LOADS},
}

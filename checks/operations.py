"""Queries for ingestion, merge, change, quality and run-log operators, each with its checking SQL."""

from __future__ import annotations

import json
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.mapping import load, raw_cte, raw_table, uid
from checks.models import AS_OF, ORACLE as MODEL_ORACLE, Query, curated, plain, staged
from ledgerlake.functions import (
    any_of,
    blank_to_null,
    drop_falsy_json,
    enum_name,
    first_id,
    iso_second,
    keep_values,
    lower_text,
    rename_values,
    text,
    upper_text,
    uuid5_key,
    zero_to_null,
)
from ledgerlake.functions.time import instant
from ledgerlake.operators import changes, lines, quality, ranking, runlog, tenants, watermark, windows
from ledgerlake.operators.upsert import delete_insert, latest_by, replace_children, upsert
from ledgerlake.plans import audits, marts, staging
from ledgerlake.sources import pages
from ledgerlake.sources.entities import ENTITIES
from ledgerlake.sources.parse import parse_entity, split_valid

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return register


LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
LINE_KEYS = ["l_orderkey", "l_linenumber"]


def last_line(where: str, name: str) -> str:
    others = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
    ties = ", ".join(f"{c} desc" for c in others.split(", "))
    return (
        f"{name} as (select {LINE_COLUMNS} from (select *, row_number() over (partition by l_orderkey, l_linenumber "
        f"order by l_shipdate desc, {ties}) as rn from lineitem where {where}) where rn = 1)"
    )


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    items = load(spark, sf_dir, "lineitem")
    old = latest_by(items.where("l_linestatus = 'F'"), LINE_KEYS, ["l_shipdate"])
    return old, items.where("l_linestatus = 'O'")


# ── merges ───────────────────────────────────────────────────────────────────────────────────────


@check(
    "latest_by",
    f"with {last_line('true', 'kept')} select {LINE_COLUMNS} from kept",
)
def q_latest_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by(load(spark, sf_dir, "lineitem"), LINE_KEYS, ["l_shipdate"])


@check(
    "upsert_latest",
    f"""with {last_line("l_linestatus = 'F'", 'old')}, {last_line("l_linestatus = 'O'", 'new')}
select * from new union all
select * from old o where not exists
    (select 1 from new n where n.l_orderkey = o.l_orderkey and n.l_linenumber = o.l_linenumber)""",
)
def q_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _two_batches(spark, sf_dir)
    return upsert(target, batch, LINE_KEYS, ["l_shipdate"])


@check(
    "upsert_insert_only",
    f"""with {last_line("l_linestatus = 'F'", 'old')}, {last_line("l_linestatus = 'O'", 'new')}
select n.* replace (
           case when o.l_orderkey is null then n.l_shipdate else o.l_shipdate end as l_shipdate,
           case when o.l_orderkey is null then nullif(n.l_returnflag, 'R') else nullif(o.l_returnflag, 'A') end
               as l_returnflag),
       timestamp '1998-06-01 00:00:00' as loaded_at
from new n left join old o on n.l_orderkey = o.l_orderkey and n.l_linenumber = o.l_linenumber
union all
select o.* replace (nullif(o.l_returnflag, 'A') as l_returnflag), timestamp '1990-01-01 00:00:00' from old o
where not exists (select 1 from new n where n.l_orderkey = o.l_orderkey and n.l_linenumber = o.l_linenumber)""",
)
def q_upsert_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _two_batches(spark, sf_dir)
    old = target.withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("A"))).withColumn(
        "loaded_at", instant(datetime(1990, 1, 1))
    )
    new = latest_by(batch, LINE_KEYS, ["l_shipdate"]).withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("R")))
    return plain(upsert(old, new, LINE_KEYS, insert_only=["l_shipdate", "l_returnflag"], loaded_at=AS_OF))


CUT = "timestamp '2024-01-20 00:00:00'"


@check(
    "incremental_slice",
    f"""select event_id, user_id, event_type, ts from events
where ts > (select max(ts) + interval 60 seconds from events where ts < {CUT})""",
)
def q_incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    built = source.where(f"ts < {CUT}").select((F.col("ts") + F.expr("interval 60 seconds")).alias("staged_at"))
    return watermark.incremental_slice(source, built, loaded="ts")


@check(
    "delete_insert",
    f"""select event_id, event_type, value * 2 as value from events where ts >= {CUT} or event_type = 'click'
union all select event_id, event_type, value from events where ts < {CUT} and event_type <> 'click'""",
)
def q_delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = load(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    target = slim.where(f"ts < {CUT}").drop("ts")
    batch = slim.where(f"ts >= {CUT} or event_type = 'click'").drop("ts").withColumn("value", F.col("value") * 2)
    return delete_insert(target, batch, ["event_id"])


@check(
    "schema_append",
    f"""select event_id, event_type, case when ts >= {CUT} then props end as props from events""",
)
def q_schema_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    slim = load(spark, sf_dir, "events")
    target = slim.where(f"ts < {CUT}").select("event_id", "event_type")
    batch = slim.where(f"ts >= {CUT}").select("event_id", "event_type", "props")
    return delete_insert(target, batch, ["event_id"])


@check(
    "replace_children",
    """with batch as (select conv_id, turn, 'new' as role from conversations where role = 'system')
select * from batch union all
select conv_id, turn, role from conversations c where not exists (select 1 from batch b where b.conv_id = c.conv_id)""",
)
def q_replace_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    batch = target.where("role = 'system'").withColumn("role", F.lit("new"))
    return replace_children(target, batch, "conv_id")


@check(
    "explode_lines",
    """with parts as (select doc_id, string_split(text, chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) - 1 as pos from parts)
select doc_id, cast(case when pos % 4 = 0 then pos + 1 else pos + 101 end as int) as numero_item, line from lines""",
)
def q_explode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of whole texts as items; every fourth carries no usable number of its own."""
    docs = load(spark, sf_dir, "documents").select(
        "doc_id",
        F.transform(
            F.split("text", "\n", -1),
            lambda x, i: F.struct(
                x.alias("line"),
                F.when(i % 8 == 0, None).when(i % 4 == 0, 0).otherwise(i + 101).alias("numero_item"),
            ),
        ).alias("itens"),
    )
    return lines.explode_lines(docs, "itens", ["doc_id"])


OID = "6ba7b8129dad11d180b400c04fd430c8"


def duck_uuid5(name: str) -> str:
    digest = f"sha1(from_hex('{OID}') || encode({name}))"
    return (
        f"concat_ws('-', substr({digest}, 1, 8), substr({digest}, 9, 4), '5' || substr({digest}, 14, 3), "
        f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({digest}, 18, 3), "
        f"substr({digest}, 21, 12))"
    )


@check(
    "uuid5_key",
    f"""select event_id, {duck_uuid5("concat('saldo|', user_id, '|', cast(cast(ts as date) as string), '|é')")} as key,
coalesce(case when event_id % 5 = 0 then 'own' end, case when event_id % 7 = 0 then event_type end,
         {duck_uuid5("concat('ev|', event_id)")}) as id from events""",
)
def q_uuid5_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id",
        uuid5_key(F.lit("saldo"), "user_id", F.col("ts").cast("date"), F.lit("é")).alias("key"),
        first_id(
            F.expr("case when event_id % 5 = 0 then 'own' when event_id % 3 = 0 then '' end"),
            F.expr("case when event_id % 7 = 0 then event_type end"),
            uuid5_key(F.lit("ev"), "event_id"),
        ).alias("id"),
    )


@check(
    "generated_item_ids",
    f"""select l_orderkey, l_linenumber,
       case when l_partkey % 4 = 0 then 'given' else {duck_uuid5("concat('venda_item|', l_orderkey, '|', l_linenumber, '|', case when l_partkey % 3 = 0 then '' else cast(l_partkey as string) end)")} end as sale_item,
       {duck_uuid5("concat('nf_item|', l_orderkey, '|', l_linenumber)")} as invoice_item from lineitem""",
)
def q_generated_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "case when l_partkey % 4 = 0 then 'given' else '' end as own",
        "case when l_partkey % 3 = 0 then null else cast(l_partkey as string) end as code",
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        lines.sale_item_id("own", "l_orderkey", "l_linenumber", "code").alias("sale_item"),
        lines.invoice_item_id(F.lit(None), "l_orderkey", "l_linenumber").alias("invoice_item"),
    )


# ── watermarks and windows ───────────────────────────────────────────────────────────────────────


@check(
    "high_water",
    """select max(coalesce(case when l_partkey % 4 = 0 then null else l_shipdate end, o_orderdate)) as high_water
from lineitem join orders on o_orderkey = l_orderkey""",
)
def q_high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "case when l_partkey % 4 = 0 then null else l_shipdate end as changed"
    )
    parent = load(spark, sf_dir, "orders").selectExpr("o_orderkey as l_orderkey", "o_orderdate as parent_changed")
    return watermark.high_water(child.join(parent, "l_orderkey"), "changed", "parent_changed")


@check(
    "watermark_state",
    """with per as (
    select event_type, max(case when ts < timestamp '2024-01-20 00:00:00' then ts end) as early, max(ts) as late,
           count(*) as n, count(*) filter (ts < timestamp '2024-01-20 00:00:00') as n_early
    from events group by event_type)
select 't1' as tenant, 'erp' as source, event_type as entity,
       concat('{"type":"timestamp","value":"', strftime(case when event_type = 'click' then early else late end,
              '%Y-%m-%dT%H:%M:%S'), '"}') as watermark,
       case when event_type = 'click' then n_early else n end as rows_loaded
from per""",
)
def q_watermark_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of two runs over all events, written and read as the loads do; the second run saw nothing of one entity."""
    events = load(spark, sf_dir, "events")

    def run(rows: DataFrame) -> DataFrame:
        seen = rows.groupBy("event_type").agg(F.max("ts").alias("t"), F.count(F.lit(1)).alias("n")).collect()
        parts = [
            watermark.watermark_row(spark, "t1", "erp", r["event_type"], r["t"].replace(microsecond=0), r["n"], None, AS_OF) for r in seen
        ]
        return reduce(DataFrame.unionByName, parts)

    state = upsert(run(events.where(f"ts < {CUT}")), run(events.where("event_type <> 'click'")), watermark.WATERMARK_KEYS)
    stored = spark.createDataFrame(state.collect(), watermark.WATERMARK_SCHEMA)  # a row per entity
    marks = [
        (r["entity"], json.dumps(watermark.get_watermark(stored, "t1", "erp", r["entity"]), separators=(",", ":")))
        for r in stored.select("entity").collect()
    ]
    found = spark.createDataFrame(marks, "entity string, watermark string")
    return stored.select("tenant", "source", "entity", "rows_loaded").join(found, "entity")


@check(
    "window_watermark",
    """select event_id, event_type, ts from events
where ts between timestamp '2024-01-05 10:00:00' and timestamp '2024-01-25 12:30:00'""",
)
def q_window_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    since, until = watermark.window_bounds(
        datetime(2024, 1, 25, 12, 30, 0, 5), {"type": "timestamp", "value": "2024-01-05T10:00:00.750"}
    )
    return load(spark, sf_dir, "events").select("event_id", "event_type", "ts").where(
        watermark.in_window("ts", since, until)
    )


@check(
    "rolling_window",
    """select o_orderkey, o_orderdate from orders
where cast(o_orderdate as date) between date '1998-06-01' - 365 and date '1998-06-01'
  and o_orderdate + interval 1 day >= timestamp '1997-09-01 00:00:00'""",
)
def q_rolling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    changed = orders.withColumn("changed", F.col("o_orderdate") + F.expr("interval 1 day"))
    return changed.where(
        windows.rolling_window("o_orderdate", 365, AS_OF.date())
        & windows.changed_since("changed", datetime(1997, 9, 1))
    ).drop("changed")


@check(
    "date_chunks",
    """with chunks as (
    select cast(i as int) as chunk, cast(date '1993-06-02' + cast(i * 16 as int) as date) as chunk_start
    from range(0, 115) r(i)
), bounded as (select *, least(cast(chunk_start + 15 as date), date '1998-06-01') as chunk_end from chunks
               where chunk_start <= date '1998-06-01')
select chunk, chunk_start, chunk_end, count(o_orderkey) as n
from bounded left join orders on cast(o_orderdate as date) between chunk_start and chunk_end
group by chunk, chunk_start, chunk_end""",
)
def q_date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = date(1993, 6, 2), AS_OF.date()
    chunks = windows.date_chunks(spark, start, end, 15)
    inside = load(spark, sf_dir, "orders").where(F.col("o_orderdate").cast("date").between(F.lit(start), F.lit(end)))
    return windows.count_by_chunk(inside, "o_orderdate", chunks, start, 15)


# ── changes ──────────────────────────────────────────────────────────────────────────────────────

SINCE = "timestamp '2000-06-01 00:00:00'"


@check(
    "changed_keys",
    f"""with changed as (
    select o_orderkey as id from orders where o_orderdate > {SINCE}
    union all select l_orderkey from lineitem where l_shipdate > {SINCE} and l_returnflag = 'A')
select l_orderkey, l_linenumber, l_partkey, l_extendedprice from lineitem where l_orderkey in (select id from changed)""",
)
def q_changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    receivables = load(spark, sf_dir, "orders").selectExpr("o_orderkey as id", "o_orderdate as data_alteracao")
    payables = (
        load(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'A'")
        .selectExpr("l_orderkey as id", "l_shipdate as data_alteracao")
    )
    keys = changes.changed_keys([receivables, payables], since=datetime(2000, 6, 1))
    detail = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return changes.follow(detail, keys, "l_orderkey")


@check(
    "parents_newest_first",
    """select o_orderkey as id, case when o_orderkey % 5 = 0 then null else o_orderdate end as data_alteracao from orders""",
)
def q_parents_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id", "case when o_orderkey % 5 = 0 then null else o_orderdate end as data_alteracao"
    )
    return changes.changed_keys(parents, newest_first=True)


@check(
    "change_log",
    """with log as (select user_id, max(ts) as seen from events
                 where ts between timestamp '2024-01-10 00:00:00' and timestamp '2024-01-20 00:00:00' group by user_id)
select c_custkey, c_name, c_acctbal from customer where c_custkey in (select user_id from log)""",
)
def q_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log keyed by id (last entry wins) drives which customers are read again."""
    seen = load(spark, sf_dir, "events").selectExpr("user_id as id", "ts as data_alteracao", "event_id").where(
        watermark.in_window("data_alteracao", datetime(2024, 1, 10), datetime(2024, 1, 20))
    )
    log = latest_by(seen, ["id"], ["data_alteracao", "event_id"])
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return changes.follow(customers, log, "c_custkey")


@check(
    "with_parent",
    """select l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_returnflag, 'N'), o_orderstatus) as kept,
       o_orderpriority as taken
from lineitem join orders on o_orderkey = l_orderkey""",
)
def q_with_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    child = load(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "nullif(l_returnflag, 'N') as kept", "l_linestatus as taken"
    )
    parent = load(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as l_orderkey", "o_orderstatus as kept", "o_orderpriority as taken"
    )
    once = changes.with_parent(child, parent, ["l_orderkey"], ["kept"])
    return changes.with_parent(once, parent, ["l_orderkey"], ["taken"], overwrite=True)


SCAN_JSON = (
    "case event_id % 8 "
    "when 0 then concat('{\"cobranca\":{\"id\":\"c', cast(event_id % 4000 as string), '\"}}') "
    "when 1 then concat('{\"a\":{\"cobrancas\":[{\"id\":\"l', cast(event_id % 4000 as string), '\"},{\"id\":\"\"},7,{\"id_cobranca\":\"no\"}]}}') "
    "when 2 then concat('{\"l\":[{\"b\":{\"id_cobranca\":\"d', cast(event_id % 4000 as string), '\"}}]}') "
    "when 3 then concat('{\"cobranca\":{\"n\":{\"id_cobranca\":\"n', cast(event_id as string), '\"}}}') "
    "when 4 then concat('{\"cobranca\":{\"id\":', cast(event_id as string), ',\"x\":{\"id_cobranca\":\"hidden\"}}}') "
    "when 5 then props when 6 then null else '[[{\"cobranca\":\"text\"}],\"{\\\\\"id_cobranca\\\\\":\\\\\"quoted\\\\\"}\"]' end"
)


@check(
    "scan_ids",
    """select distinct case event_id % 8 when 0 then concat('c', event_id % 4000) when 1 then concat('l', event_id % 4000)
       when 2 then concat('d', event_id % 4000) when 3 then concat('n', event_id) when 4 then cast(event_id as string) end as id
from events where event_id % 8 < 5""",
)
def q_scan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.scan_ids(load(spark, sf_dir, "events").selectExpr(f"{SCAN_JSON} as raw"), "raw")


@check(
    "daily_snapshot",
    f"""with accounts as (select c_custkey, {uid('33000000', 'c_custkey')} as conta, c_acctbal from customer
                          where c_custkey % 3 <> 0 or c_custkey % 6 = 3),
days as (select *, date '1998-05-31' as snapshot_date, 1 as sign from accounts
         union all select *, date '1998-06-01', 2 from accounts)
select {duck_uuid5("concat('saldo_atual|', conta, '|', cast(snapshot_date as string))")} as id,
       conta as conta_financeira_id, cast(cast(c_acctbal as decimal(18,4)) * sign as decimal(18,4)) as saldo_atual,
       cast(null as decimal(18,4)) as saldo, snapshot_date,
       case when sign = 1 then timestamp '1998-05-31 08:00:00' else timestamp '1998-06-01 20:00:00' end as data_snapshot
from days""",
)
def q_daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on two days: the second run of a day overwrites the first, days add up."""
    customers = load(spark, sf_dir, "customer")
    account = uid("33000000", "c_custkey")
    accounts = customers.selectExpr(
        f"{account} as id", "case when c_custkey % 3 <> 0 then true when c_custkey % 6 = 3 then null else false end as ativo"
    )

    def run(now: datetime, factor: int) -> DataFrame:
        balances = customers.selectExpr(
            f"{account} as conta_financeira_id",
            f"cast(cast(c_acctbal as decimal(18,4)) * {factor} as decimal(18,4)) as saldo_atual",
            "cast(null as decimal(18,4)) as saldo",
        )
        return lines.daily_snapshot(accounts, balances, now)

    entity = ENTITIES["saldo_atual"]
    table = run(datetime(1998, 5, 31, 8), 1)
    for moment, factor in ((datetime(1998, 6, 1, 8), 5), (datetime(1998, 6, 1, 20), 2)):
        table = upsert(table, run(moment, factor), entity.keys, insert_only=entity.insert_only)
    return plain(table)


# ── landed pages ─────────────────────────────────────────────────────────────────────────────────


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as landed responses of 100 items, in every envelope; groups are bounded by the page size."""
    item = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast("decimal(18,4)").alias("total"),
        )
    )
    grouped = (
        load(spark, sf_dir, "orders")
        .select(F.floor(F.col("o_orderkey") / 100).cast("bigint").alias("page"), "o_orderkey", item.alias("item"))
        .groupBy("page")
        .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "item"))).alias("rows"))
    )
    listed = F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["item"]), ","), F.lit("]"))
    total = F.size("rows").cast("string")

    def envelope(key: str, total_text: Column) -> Column:
        return F.concat(F.lit("{"), total_text, F.lit(f',"{key}":'), listed, F.lit("}"))

    kind = F.col("page") % 6
    body = (
        F.when(kind == 0, envelope("itens", F.concat(F.lit('"itens_totais":'), total)))
        .when(kind == 1, envelope("items", F.concat(F.lit('"totalItems":'), total)))
        .when(kind == 2, envelope("dados", F.concat(F.lit('"total_itens":'), total)))
        .when(kind == 3, envelope("data", F.concat(F.lit('"paginacao":{"total_itens":'), total, F.lit("}"))))
        .when(kind == 4, listed)
        .otherwise(envelope("outros", F.concat(F.lit('"total":'), total)))
    )
    return grouped.select((F.col("page") % 10).alias("endpoint"), "page", body.alias("body"))


@check(
    "page_unwrap",
    """select o_orderkey as id, o_orderstatus as status, cast(o_totalprice as decimal(18,4)) as total
from orders where (o_orderkey // 100) % 6 <> 5""",
)
def q_page_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = pages.unwrap_pages(_pages(spark, sf_dir))
    parsed = items.select(F.from_json("item", "id bigint, status string, total decimal(18,4)").alias("p"))
    return parsed.select("p.*")


@check(
    "page_reconcile",
    """with p as (select o_orderkey // 100 as page, count(*) as n from orders group by 1),
k as (select page, page % 10 as endpoint, page % 6 as kind, case when page % 6 = 4 then null else n end as total,
             case when page % 6 = 5 then 0 else n end as n from p)
select endpoint, cast(count(*) * times as bigint) as pages, arg_min(total, page) filter (total is not null) as expected,
       cast(sum(n) * times as bigint) as received, cast(sum(n) as bigint) as distinct_items,
       cast(greatest(arg_min(total, page) filter (total is not null) - sum(n), 0) as bigint) as missing,
       case when arg_min(total, page) filter (total is not null) is null then 'unknown'
            when arg_min(total, page) filter (total is not null) > sum(n) then 'short'
            when times > 1 and sum(n) > 0 then 'repeated' else 'complete' end as status
from (select *, case when endpoint < 3 then 2 else 1 end as times from k) group by endpoint, times""",
)
def q_page_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of the ten endpoints delivered every page twice."""
    once = _pages(spark, sf_dir)
    return pages.reconcile_pages(once.unionByName(once.where("endpoint < 3")))


ITEM_JSON = (
    "case o_orderkey % 10 when 7 then '{\"id\":\"bad\",\"total\":1}' when 8 then '{\"total\":1}' when 9 then '{broken' else "
    f"concat('{{\"id\":\"', upper({uid('1a000000', 'o_orderkey')}), '\",\"numero\":', cast(o_orderkey as string), "
    "',\"situacao\":', case when o_orderkey % 2 = 0 then '{\"nome\":\"APROVADO\",\"descricao\":\"x\"}' else '\"CANCELADO\"' end, "
    "',\"tipo\":\"  \",\"itens\":\"PRODUCT\",\"total\":', cast(cast(o_totalprice as decimal(18,2)) as string), "
    "'6666,\"data\":\"', cast(cast(o_orderdate as date) as string), '\",\"criado_em\":\"', "
    "cast(cast(o_orderdate as date) as string), 'T14:26:00.728\",\"cliente\":{\"id\":\"', cast(o_custkey as string), "
    "'\",\"nome\":\"n\"},\"categoria\":{},\"novo_campo\":[1,2]}') end"
)


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "orders").selectExpr(f"{ITEM_JSON} as item", "o_orderkey as position")
    return parse_entity(items, ENTITIES["vendas"], AS_OF, keep=("position",))


@check(
    "parse_items",
    f"""select {uid('1a000000', 'o_orderkey')} as id, o_orderkey as numero,
       case when o_orderkey % 2 = 0 then 'APROVADO' else 'CANCELADO' end as situacao, cast(null as string) as tipo,
       'PRODUCT' as tipo_item, cast(cast(o_totalprice as decimal(18,2)) + 0.0067 as decimal(18,4)) as total,
       cast(o_orderdate as date) as data_venda,
       cast(cast(o_orderdate as date) as timestamp) + interval 14 hours + interval 26 minutes + interval 728 milliseconds as criado_em,
       cast(o_custkey as string) as cliente_id, cast(null as string) as categoria, true as raw_kept
from orders where o_orderkey % 10 < 7""",
)
def q_parse_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split_valid(_parsed(spark, sf_dir))
    return plain(
        valid.select(
            "id", "numero", "situacao", "tipo", "tipo_item", "total", "data_venda", "criado_em",
            F.col("cliente.id").alias("cliente_id"), "categoria",
            (F.get_json_object("raw", "$.novo_campo") == "[1,2]").alias("raw_kept"),
        )
    )


@check(
    "quarantine",
    """select case o_orderkey % 10 when 7 then 'malformed id' when 8 then 'missing id' else 'not readable as declared' end as problem,
       count(*) as n from orders where o_orderkey % 10 >= 7 group by 1""",
)
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split_valid(_parsed(spark, sf_dir))
    return rejected.groupBy(F.col("_problem").alias("problem")).agg(F.count(F.lit(1)).alias("n"))


@check(
    "demo_ingest",
    """select c_custkey as id, case when c_acctbal < 0 then concat('Customer ', c_custkey) else c_name end as name,
       timestamp '1998-06-01 00:00:00' as ingested_at,
       case when c_acctbal < 0 then timestamp '1998-06-01 00:00:00' else timestamp '1998-05-01 00:00:00' end as loaded_at
from customer""",
)
def q_demo_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id", "c_name as name", "timestamp '1998-06-01 00:00:00' as ingested_at", "c_acctbal"
    )
    target = rows.drop("c_acctbal").withColumn("loaded_at", instant(datetime(1998, 5, 1)))
    name = F.concat(F.lit("Customer "), F.col("id").cast("string"))
    batch = rows.where("c_acctbal < 0").drop("c_acctbal").withColumn("name", name)
    return plain(upsert(target, batch, ["id"], loaded_at=AS_OF))


# ── audits, quality, run log, tenants ────────────────────────────────────────────────────────────

KIND_SQL = MODEL_ORACLE["clientes_resumo"].split("select coalesce(")[1].split(", 'desconhecido')")[0]


@check(
    "document_audit",
    f"""with {raw_cte('pessoas')}
select coalesce({KIND_SQL}, 'desconhecido') as tipo_pessoa, count(*) as pessoas, count(*) filter (doc_ok) as validos,
       count(*) filter (not doc_ok) as invalidos,
       count(*) filter (nullif(trim(documento), '') is not null and doc_ok is null) as nao_avaliados,
       count(*) filter (nullif(trim(documento), '') is null) as ausentes
from raw_pessoas p group by 1""",
)
def q_document_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.audit_documents(staged(spark, sf_dir, "pessoas"))[1]


@check(
    "address_audit",
    f"""with a as ({MODEL_ORACLE['stg_pessoa_enderecos']})
select coalesce(estado, 'desconhecido') as estado, count(*) as enderecos,
       count(*) filter (cep is not null and cep_normalizado is null) as cep_invalido,
       count(*) filter (cep is null) as cep_ausente from a group by 1""",
)
def q_address_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.clean_addresses(raw_table(spark, sf_dir, "pessoas_detalhe"), AS_OF)[1]


TITLE_CHECKS = [
    quality.not_null("evento_id"),
    quality.unique("evento_id"),
    quality.not_null("status", "warn"),
    quality.not_null("data_vencimento", where="num_categorias > 0"),
    quality.accepted("num_categorias", (0, 1), "warn"),
    quality.accepted("status", ("ACQUITTED", "PENDING", "CANCELED"), where="status is not null"),
    quality.unique("cliente_id", "warn"),
    quality.singleton("num_centros_de_custo", 0),
]


@check(
    "quality_report",
    f"""with t as ({MODEL_ORACLE['stg_contas_a_receber']}),
r as (
    select 'not_null_evento_id' as check_name, 'evento_id' as column_name, 'error' as severity, count(*) filter (evento_id is null) as failures from t
    union all select 'not_null_status', 'status', 'warn', count(*) filter (status is null) from t
    union all select 'not_null_data_vencimento', 'data_vencimento', 'error', count(*) filter (data_vencimento is null and num_categorias > 0) from t
    union all select 'accepted_values_num_categorias', 'num_categorias', 'warn', count(*) filter (num_categorias not in (0, 1)) from t
    union all select 'accepted_values_status', 'status', 'error', count(*) filter (status not in ('ACQUITTED', 'PENDING', 'CANCELED')) from t
    union all select 'singleton_num_centros_de_custo', 'num_centros_de_custo', 'error', count(*) filter (num_centros_de_custo <> 0) from t
    union all select 'unique_evento_id', 'evento_id', 'error', count(*) from (select evento_id from t where evento_id is not null group by 1 having count(*) > 1)
    union all select 'unique_cliente_id', 'cliente_id', 'warn', count(*) from (select cliente_id from t where cliente_id is not null group by 1 having count(*) > 1)
)
select 'stg_contas_a_receber' as table_name, *, case when failures = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status from r""",
)
def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(staged(spark, sf_dir, "contas_a_receber"), "stg_contas_a_receber", TITLE_CHECKS)


TASKS_SQL = """tasks as (
    select concat('run', user_id) as run_id, concat('load.', event_type) as task_id,
           cast(case when event_id % 4 = 0 then -1 else event_id % 1000 end as int) as map_index,
           case when event_type = 'error' and event_id % 3 = 0 then 'failed' when event_id % 50 = 1 then 'running' else 'success' end as status,
           ts as started_at, ts + interval 90 seconds as finished_at, event_id % 10 as rows_inserted,
           case when event_id % 3 = 0 then null else event_id % 7 end as rows_updated, cast(0 as bigint) as rows_deleted,
           repeat('trace ', 700 + cast(event_id % 5 as int)) as error, event_id
    from events)"""
LOG_SQL = """log as (
    select concat(run_id, '::', task_id, case when map_index >= 0 then concat('[', map_index, ']') else '' end) as external_run_id,
           run_id, task_id, map_index, status, started_at, case when status <> 'running' then finished_at end as finished_at,
           rows_inserted, rows_updated, rows_deleted, case when status = 'failed' then error end as error_message, event_id
    from tasks)"""
LAST_SQL = """last as (select * exclude (rn) from (
    select *, row_number() over (partition by external_run_id order by event_id desc) as rn from log) where rn = 1)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = load(spark, sf_dir, "events").selectExpr(
        "concat('run', user_id) as run_id",
        "concat('load.', event_type) as task_id",
        "cast(case when event_id % 4 = 0 then -1 else event_id % 1000 end as int) as map_index",
        "case when event_type = 'error' and event_id % 3 = 0 then 'failed' when event_id % 50 = 1 then 'running' else 'success' end as status",
        "ts as started_at",
        "ts + interval 90 seconds as finished_at",
        "event_id % 10 as rows_inserted",
        "case when event_id % 3 = 0 then null else event_id % 7 end as rows_updated",
        "cast(0 as bigint) as rows_deleted",
        "repeat('trace ', 700 + cast(event_id % 5 as int)) as error",
    )
    entries = runlog.task_log(tasks)
    return latest_by(entries, runlog.RUN_LOG_KEYS, ["started_at"])


@check("run_log", f"with {TASKS_SQL}, {LOG_SQL}, {LAST_SQL} select * exclude (event_id) from last")
def q_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks that ran again under the same key overwrite their row."""
    return _log(spark, sf_dir)


@check(
    "run_rollup",
    f"""with {TASKS_SQL}, {LOG_SQL}, {LAST_SQL}
select run_id, min(started_at) as started_at, max(finished_at) as finished_at, count(*) as tasks,
       count(*) filter (status = 'failed') as tasks_failed, cast(sum(rows_inserted) as bigint) as rows_inserted,
       cast(sum(coalesce(rows_updated, 0)) as bigint) as rows_updated, cast(0 as bigint) as rows_deleted,
       case when count(*) filter (status = 'failed') = count(*) then 'failed'
            when count(*) filter (status = 'failed') > 0 then 'partial_failed'
            when count(*) filter (status = 'running') > 0 then 'running' else 'success' end as status
from last group by run_id""",
)
def q_run_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_rollup(_log(spark, sf_dir))


@check(
    "trigger_kinds",
    """select event_id, case event_type when 'click' then 'scheduled' when 'view' then 'manual' when 'signup' then 'backfill'
       when 'error' then 'asset' else 'other' end as run_type,
       case event_type when 'click' then 'airflow-scheduler'
            when 'view' then case when event_id % 2 = 0 then concat('u', user_id) else 'airflow-ui' end end as triggered_by
from events""",
)
def q_trigger_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = load(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_type when 'click' then 'scheduled' when 'view' then 'manual' when 'signup' then 'backfill_job' "
        "when 'error' then 'dataset_triggered' else event_type end as kind",
        "case when event_id % 2 = 0 then concat('u', user_id) else '' end as who",
    )
    return given.select(
        "event_id", runlog.trigger_kind("kind").alias("run_type"), runlog.triggered_by("kind", "who").alias("triggered_by")
    )


TENANT_DAYS = f"""with {raw_cte('contas_a_receber')}, tenant_rows as (
    select r.*, concat('t', o.o_custkey % 5) as tenant from raw_contas_a_receber r
    join (select {uid('10000000', 'o_orderkey')} as oid, o_custkey from orders) o on o.oid = r.id)
select r.tenant, cast(r.data_competencia as date) as dia, cast(count(*) as int) as qtd,
       cast(sum(r.total) as decimal(14,2)) as faturamento, cast(sum(r.pago) as decimal(14,2)) as recebido,
       cast(sum(r.nao_pago) as decimal(14,2)) as em_aberto
from tenant_rows r where r.data_competencia is not null
  and not coalesce(upper(nullif(trim(r.status), '')) = 'CANCELED', false)
group by 1, 2"""


@check("tenant_union", TENANT_DAYS)
def q_tenant_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tenants, each with its own source tables, one mart."""
    titles = curated(spark, sf_dir, "fct_contas_a_receber").withColumn(
        "t", F.substring("cliente_nome", 10, 9).cast("bigint") % 5
    )
    sources = {f"t{i}": (titles.where(F.col("t") == i).drop("t"),) for i in range(5)}
    return plain(tenants.for_tenants(marts.fin_receita_diaria, sources))


@check("tenant_rollup", TENANT_DAYS)
def q_tenant_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tenants in one table: one scan and one aggregation for all."""
    number = (F.substring("cliente_nome", 10, 9).cast("bigint") % 5).cast("string")
    titles = curated(spark, sf_dir, "fct_contas_a_receber").withColumn("tenant", F.concat(F.lit("t"), number))
    return plain(marts.fin_receita_diaria(titles, by=["tenant"]))


@check(
    "global_rank",
    "select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as seq from orders",
)
def q_global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.global_row_number(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], "seq")


# ── scalar functions ─────────────────────────────────────────────────────────────────────────────


@check(
    "text_cleaning",
    """select doc_id, nullif(trim(text), '') as trimmed, lower(lang) as low, upper(source) as up,
       case when doc_id % 3 <> 0 then lang end as not_blank,
       case when doc_id % 4 = 0 then 'pf' when doc_id % 4 = 1 then 'pj' end as kind,
       case when doc_id % 4 = 0 then 'fisica' end as listed, doc_id % 4 = 1 as is_one,
       nullif(doc_id % 5, 0) as not_zero
from documents""",
)
def q_text_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").selectExpr(
        "*",
        "case doc_id % 4 when 0 then ' FISICA ' when 1 then 'Jurídica' when 2 then 'x' end as word",
        "case when doc_id % 3 = 0 then ' \t\n' else lang end as maybe",
        "doc_id % 5 as n",
    )
    return docs.select(
        "doc_id",
        text("text").alias("trimmed"),
        lower_text("lang").alias("low"),
        upper_text("source").alias("up"),
        blank_to_null("maybe").alias("not_blank"),
        rename_values("word", staging.PERSON_KINDS).alias("kind"),
        keep_values("word", "fisica", "outra").alias("listed"),
        any_of("word", "JURÍDICA").alias("is_one"),
        zero_to_null("n").alias("not_zero"),
    )


@check(
    "json_scalars",
    """select event_id, cast(json_extract_string(props, '$.k') as int) as k,
       case when event_id % 2 = 0 then 'APROVADO' else 'X' end as named,
       case event_id % 6 when 4 then '{"a":1}' when 5 then '[1]' end as not_empty,
       cast(event_id % 4 as int) as n_items, coalesce(case when event_id % 4 > 0 then event_id % 4 - 1 end, 9) as last_item,
       case when event_id % 3 = 0 then event_type else cast(user_id as string) end as first_present,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso
from events""",
)
def q_json_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").selectExpr(
        "*",
        "case when event_id % 2 = 0 then ' {\"nome\":\"APROVADO\"}' else 'X' end as enum",
        "case event_id % 6 when 0 then '{}' when 1 then ' [ ] ' when 2 then 'null' when 3 then null when 4 then '{\"a\":1}' else '[1]' end as bag",
        "to_json(if(event_id % 4 = 0, cast(array() as array<bigint>), sequence(0, event_id % 4 - 1))) as arr",
        "case when event_id % 3 = 0 then event_type end as alias_a",
        "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\"), case event_id % 4 when 0 then '.123Z' when 1 then '+03:00' when 2 then '-03:00' else '' end) as stamp",
    )
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.trim(enum_name("enum")).alias("named"),
        drop_falsy_json("bag").alias("not_empty"),
        F.coalesce(F.json_array_length("arr"), F.lit(0)).alias("n_items"),
        F.coalesce(
            F.get(F.from_json("arr", "array<bigint>"), F.json_array_length("arr") - 1), F.lit(9)
        ).alias("last_item"),
        F.coalesce("alias_a", F.col("user_id").cast("string")).alias("first_present"),
        iso_second("stamp").alias("iso"),
    )

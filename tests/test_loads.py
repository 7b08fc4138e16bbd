"""A whole tenant run: every entity loaded, every model built, checks evaluated."""

import json
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.watermark import get_watermark, watermark_row
from ledgerlake.plans import loads
from ledgerlake.plans.registry import MODELS
from ledgerlake.sources.entities import ENTITIES
from ledgerlake.sources.pages import read_pages, unwrap_pages
from ledgerlake.sources.parse import parse_entity
from ledgerlake.sources.tables import read, ref, source, table_name

NOW = datetime(2024, 6, 1, 12, 0, 0)


def uid(kind, n):
    return f"{kind:08d}-0000-4000-8000-{n:012d}"


def sample(field, n):
    return {
        "uuid": uid(1, n),
        "text": f"T{n}",
        "clean": f" c{n} ",
        "enum": {"nome": f"E{n}"},
        "money": 10.12345 + n,
        "int": n,
        "long": n,
        "bool": n % 2 == 0,
        "date": "2024-05-01",
        "ts": f"2024-05-{10 + n % 18:02d}T10:00:00.5Z",
        "bag": {"n": n},
        "names": ["Cliente"],
        "party": {"id": uid(2, n), "nome": f" P{n}", "email": "A@B"},
        "refs": [{"id": uid(3, n), "nome": "r"}],
        "addresses": [{"cep": "01310-100", "cidade": "X", "id_cidade": 0}, {"cep": " "}],
        "subitems": [{"descricao": "S", "codigo": "1", "categorias_financeiras": [{"id": uid(1, n), "nome": "L"}]}],
    }[field.kind]


def record(name, n, **given):
    entity = ENTITIES[name]
    out = {}
    for f in entity.fields:
        key = f.aliases[0] if f.aliases else f.name
        out[key] = f"1000{n}" if f.kind == "text" and f.name == "codigo" else sample(f, n)
    return {**out, **given}


def items(spark, records, **columns):
    rows = [(json.dumps(r), i) for i, r in enumerate(records)]
    df = spark.createDataFrame(rows, "item string, position int")
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


@pytest.fixture(scope="module")
def loaded(spark):
    tenant = f"t{uuid.uuid4().hex[:8]}"
    for name in ENTITIES:
        if name == "customers":
            data = [{"id": i, "name": f"Customer {i}", "ingested_at": "2024-05-01T00:00:00"} for i in range(1, 26)]
        elif name == "conta_conectada":
            data = [record(name, 1)]
        else:
            data = [record(name, n) for n in range(1, 5)]
        count, rejected = loads.load_entity(spark, tenant, name, items(spark, data), NOW, "run1", buckets=2)
        assert count == len(data), name
        assert rejected.count() == 0, name
    return tenant


def test_every_entity_is_declared():
    assert len(ENTITIES) == 35
    kept = {name for name, e in ENTITIES.items() if "data_criacao" in e.insert_only}
    assert kept == {
        "pessoas", "produtos", "produtos_detalhe", "servicos_detalhe", "contas_a_receber", "contas_a_pagar",
        "transferencias", "parcelas_detalhe", "baixas", "contratos", "contratos_detalhe",
    }


def test_every_model_builds_and_has_its_rows(spark, loaded):
    assert len(MODELS) == 35 + 29 + 7
    loads.build_models(spark, loaded, as_of=NOW, buckets=2)
    for name, model in MODELS.items():
        df = ref(spark, table_name(loaded, model.layer, name))
        assert df.count() > 0, name
    money = ref(spark, table_name(loaded, "curated", "fct_contas_a_receber")).select("valor_total").first()[0]
    assert str(money) in {"11.1235", "12.1235", "13.1235", "14.1235"}
    result = loads.check_models(spark, loaded)
    failed = {(r["table_name"], r["check_name"]) for r in result.where("status = 'fail'").collect()}
    assert failed == {
        ("stg_categorias_financeiras", "accepted_values_tipo"),
        ("stg_notas_fiscais", "accepted_values_status"),
    }
    raw = loads.check_raw(spark, loaded, ["pessoas", "conta_conectada", "produto_ncm"])
    assert raw.where("status <> 'pass'").count() == 0


def test_watermark_moves_only_with_values(spark, tenant):
    first = [record("pessoas", 1, data_alteracao="2024-05-03T10:00:00"), record("pessoas", 2, data_alteracao="2024-05-09T08:00:00")]
    loads.load_entity(spark, tenant, "pessoas", items(spark, first), NOW, "r1", buckets=2)
    state = table_name(tenant, "raw", "etl_watermarks")
    assert get_watermark(read(spark, state), tenant, loads.SOURCE, "pessoas")["value"] == "2024-05-09T08:00:00"
    loads.load_entity(spark, tenant, "pessoas", items(spark, first[:1]), NOW, "r2", buckets=2)
    assert get_watermark(read(spark, state), tenant, loads.SOURCE, "pessoas")["value"] == "2024-05-09T08:00:00"
    assert get_watermark(read(spark, state), tenant, loads.SOURCE, "vendas") is None


def test_sale_items_get_stable_ids_and_are_replaced(spark, tenant):
    sale = uid(7, 1)

    def lines(*codes):
        return items(spark, [{"codigo": c, "quantidade": 1.5} for c in codes], venda_id=sale)

    loads.load_entity(spark, tenant, "vendas_itens", lines("a", "b", None), NOW, buckets=2)
    ids = {r["codigo"]: r["id"] for r in source(spark, tenant, "vendas_itens").collect()}
    assert ids["b"] == str(uuid.uuid5(uuid.NAMESPACE_OID, f"venda_item|{sale}|2|b"))
    assert ids[None] == str(uuid.uuid5(uuid.NAMESPACE_OID, f"venda_item|{sale}|3|"))
    loads.load_entity(spark, tenant, "vendas_itens", lines("a"), NOW, buckets=2)
    assert {r["id"] for r in source(spark, tenant, "vendas_itens").collect()} == {ids["a"]}
    loads.load_entity(spark, tenant, "vendas_itens", lines(), NOW, buckets=2)
    assert source(spark, tenant, "vendas_itens").count() == 1


def test_invoice_item_number_falls_back(spark, tenant):
    data = [{"numero_item": 5}, {"numero": 7}, {"numero_item": 0}]
    loads.load_entity(spark, tenant, "notas_fiscais_itens", items(spark, data, chave_acesso="k1"), NOW, buckets=2)
    got = {r["numero_item"]: r["id"] for r in source(spark, tenant, "notas_fiscais_itens").collect()}
    assert got == {n: str(uuid.uuid5(uuid.NAMESPACE_OID, f"nf_item|k1|{n}")) for n in (5, 7, 3)}


def test_opening_balance_aliases_and_generated_id(spark, tenant):
    data = [
        {"id_conta_financeira": uid(4, 1), "data_competencia": "2024-01-01T00:00:00", "saldo_inicial": 5, "tipo": "DESPESA"},
        {"conta_financeira": {"id": uid(4, 2)}, "data_competencia": "2024-01-02T00:00:00", "saldo_inicial": 7, "tipo": "RECEITA"},
    ]
    loads.load_entity(spark, tenant, "saldo_inicial", items(spark, data), NOW, buckets=2)
    got = {r["conta_financeira_id"]: r["id"] for r in source(spark, tenant, "saldo_inicial").collect()}
    want = f"saldo_inicial|{uid(4, 1)}|2024-01-01 00:00:00"
    assert got[uid(4, 1)] == str(uuid.uuid5(uuid.NAMESPACE_OID, want))
    assert set(got) == {uid(4, 1), uid(4, 2)}
    loads.build_models(spark, tenant, ["stg_saldo_inicial", "fct_saldo_inicial", "saldo_inicial"], NOW, buckets=2)
    assert str(ref(spark, table_name(tenant, "delivery", "saldo_inicial")).first()[0]) == "2.00"


def test_window_leaves_out_old_and_future_dues(spark, tenant):
    data = [
        record("contas_a_receber", 1, data_vencimento="2010-01-01T00:00:00"),
        record("contas_a_receber", 2, data_vencimento="2024-06-01T23:00:00"),
        record("contas_a_receber", 3, data_vencimento="2024-06-02T00:00:00"),
    ]
    count, _ = loads.load_entity(spark, tenant, "contas_a_receber", items(spark, data), NOW, buckets=2)
    assert count == 1


def test_updates_keep_the_first_creation_time(spark, tenant):
    for created, total in (("2024-01-01T00:00:00", 1), ("2024-02-02T00:00:00", 2)):
        row = record("contas_a_pagar", 1, data_criacao=created, total=total, data_vencimento="2024-05-01T00:00:00")
        loads.load_entity(spark, tenant, "contas_a_pagar", items(spark, [row]), NOW, buckets=2)
    got = source(spark, tenant, "contas_a_pagar").select("data_criacao", "total").first()
    assert got["data_criacao"] == datetime(2024, 1, 1) and got["total"] == 2


def test_incremental_build_equals_full_refresh(spark, tenant):
    first = [record("produtos", n) for n in range(1, 6)]
    second = [record("produtos", n, nome=f"new {n}") for n in range(4, 9)]
    table = table_name(tenant, "staging", "stg_produtos")
    loads.load_entity(spark, tenant, "produtos", items(spark, first), NOW, buckets=2)
    loads.build_models(spark, tenant, ["stg_produtos"], NOW + timedelta(minutes=1), buckets=2)
    later = NOW + timedelta(hours=2)
    changed = [{**r, "data_alteracao": "2024-06-01T11:00:00"} for r in second]
    loads.load_entity(spark, tenant, "produtos", items(spark, changed), later, buckets=2)
    loads.build_models(spark, tenant, ["stg_produtos"], later + timedelta(minutes=1), buckets=2)
    step = sorted(tuple(r) for r in read(spark, table).drop("staged_at").collect())
    loads.build_models(spark, tenant, ["stg_produtos"], later + timedelta(minutes=1), full_refresh=True, buckets=2)
    full = sorted(tuple(r) for r in read(spark, table).drop("staged_at").collect())
    assert step == full and len(full) == 8


def test_unusable_items_are_set_aside_or_stop_the_load(spark, tenant):
    data = [record("vendas", 1), record("vendas", 2, id="nope"), {"numero": 3}]
    count, rejected = loads.load_entity(spark, tenant, "vendas", items(spark, data), NOW, buckets=2)
    assert count == 1
    assert sorted(r["_problem"] for r in rejected.collect()) == ["malformed id", "missing id"]
    with pytest.raises(Exception, match="unusable item"):
        loads.load_entity(spark, tenant, "vendas", items(spark, data), NOW, mode="fail", buckets=2)


def test_later_page_wins_over_place_on_the_page(spark, tenant, tmp_path):
    pages_dir = tmp_path / "landed"
    pages_dir.mkdir()
    new, old = record("contas_a_receber", 1, descricao="new"), record("contas_a_receber", 1, descricao="old")
    (pages_dir / "page-1.json").write_text(json.dumps({"itens": [record("contas_a_receber", 2), old]}))
    (pages_dir / "page-2.json").write_text(json.dumps({"itens": [new]}))
    found = unwrap_pages(read_pages(spark, str(pages_dir)))
    loads.load_entity(spark, tenant, "contas_a_receber", found, NOW, buckets=2)
    rows = {r["id"]: r["descricao"] for r in source(spark, tenant, "contas_a_receber").collect()}
    assert len(rows) == 2 and rows[new["id"]] == "new"


def test_children_delivered_twice_count_once(spark, tenant):
    sale = uid(7, 2)
    both = [("p1", "a", 1.0), ("p1", "b", 2.0), ("p2", "a", 3.0)]
    rows = [(json.dumps({"codigo": c, "quantidade": q}), k % 2, p, sale) for k, (p, c, q) in enumerate(both)]
    df = spark.createDataFrame(rows, "item string, position int, page string, venda_id string")
    loads.load_entity(spark, tenant, "vendas_itens", df, NOW, buckets=2)
    assert [float(r["quantidade"]) for r in source(spark, tenant, "vendas_itens").collect()] == [3.0]


def test_daily_balances_are_keyed_by_account_and_day(spark, tenant):
    def day(now, amount):
        data = [{"conta_financeira_id": uid(33, 1), "saldo_atual": amount}]
        loads.load_entity(spark, tenant, "saldo_atual", items(spark, data), now, buckets=2)

    day(datetime(2024, 5, 10, 8), 1)
    day(datetime(2024, 5, 10, 20), 2)
    day(datetime(2024, 5, 11, 8), 3)
    rows = source(spark, tenant, "saldo_atual").orderBy("snapshot_date").collect()
    assert [(str(r["snapshot_date"]), int(r["saldo_atual"])) for r in rows] == [("2024-05-10", 2), ("2024-05-11", 3)]


def test_rows_without_a_change_time_are_not_lost(spark, tenant):
    loads.load_entity(spark, tenant, "vendas", items(spark, [record("vendas", 1)]), NOW, buckets=2)
    later = [record("vendas", 2, data_alteracao=None)]
    count, rejected = loads.load_entity(spark, tenant, "vendas", items(spark, later), NOW, buckets=2)
    assert count == 1 and rejected.count() == 0


def test_rows_outside_the_window_are_told(spark, tenant):
    loads.load_entity(spark, tenant, "vendas", items(spark, [record("vendas", 1)]), NOW, buckets=2)
    old = [record("vendas", 2, data_alteracao="2001-01-01T00:00:00")]
    count, rest = loads.load_entity(spark, tenant, "vendas", items(spark, old), NOW, buckets=2)
    assert count == 0 and [r["_problem"] for r in rest.collect()] == [loads.OUTSIDE]


def test_marks_are_kept_apart(spark, tenant):
    state = loads.ensure_state(spark, tenant)
    for entity, value in [("a", "1"), ("b", "2"), ("a", "3")]:
        row = watermark_row(spark, tenant, loads.SOURCE, entity, value, 1, "r", NOW, "id")
        row.select(*spark.table(state).columns).write.insertInto(state, overwrite=True)
    found = {e: get_watermark(read(spark, state), tenant, loads.SOURCE, e)["value"] for e in "ab"}
    assert found == {"a": "3", "b": "2"}


def test_first_list_that_is_not_empty_counts(spark):
    bodies = ['{"itens": [], "produtos": [{"id": 1}]}', '{"itens": [ {"id": 2} ], "data": [{"id": 3}]}', '{"data": null}']
    pages = spark.createDataFrame([(b,) for b in bodies], "body string")
    found = unwrap_pages(pages, filled=ENTITIES["notas_fiscais_itens"].options["item_keys"])  # the rule of one endpoint
    assert sorted(r["item"] for r in found.collect()) == ['{"id":1}', '{"id":2}']


def test_ids_are_hashed_once_and_items_parsed_once(spark, tenant, monkeypatch):
    plans = []
    stored = loads.write_once
    monkeypatch.setattr(loads, "write_once", lambda rows, name: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or stored(rows, name))
    sale = uid(7, 3)
    loads.load_entity(spark, tenant, "vendas_itens", items(spark, [{"codigo": "a"}], venda_id=sale), NOW)
    assert plans[0].count("sha1(") == 1
    assert plans[0].count("from_json(") == 1
    assert source(spark, tenant, "vendas_itens").first()["id"] == str(uuid.uuid5(uuid.NAMESPACE_OID, f"venda_item|{sale}|1|a"))


def test_line_numbers_with_escaped_names_are_found(spark, tenant):
    texts = ['{"codigo": "a", "numero_item": 4}', '{"codigo": "a", "numero\\u005fitem": "6"}', '{"codigo": "a"}']
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "item string, position int").withColumn("venda_id", F.lit(uid(7, 4)))
    loads.load_entity(spark, tenant, "vendas_itens", rows, NOW)
    ids = {r["id"] for r in source(spark, tenant, "vendas_itens").collect()}
    assert ids == {str(uuid.uuid5(uuid.NAMESPACE_OID, f"venda_item|{uid(7, 4)}|{n}|a")) for n in (4, 6, 3)}


def test_last_deliveries_are_chosen_once_and_stored(spark):
    rows = [("p", 1, "x", "a"), ("p", 2, "a", "b"), ("p", 2, "z", "c"), ("q", None, None, "d"), ("q", 1, None, "e"), ("r", None, None, "f"), (None, 1, "x", "g")]
    df = spark.createDataFrame(rows, "parent string, page int, source_file string, child string")
    for order, kept in ((["page"], "bcefg"), (["page", "source_file"], "cefg"), ([], "abcdefg")):
        late = loads.latest_delivery(df, "parent", order)
        assert sorted(r["child"] for r in late.collect()) == list(kept) and late.columns == df.columns
    plan = loads.latest_delivery(df, "parent", ["page"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_ids_are_checked_once(spark):
    entity = ENTITIES["vendas_itens"]
    given = items(spark, [{"id": uid(1, 1)}, {"id": " "}, {"id": "x"}, {"id": f" {uid(1, 2).upper()} "}], venda_id=uid(7, 5))
    rows = parse_entity(given, entity, NOW, keep=("position", "venda_id"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[0-9a-f]{12}") == sum(f.kind == "uuid" for f in entity.fields)
    found = [(r["id"], r["venda_id"], r["_problem"]) for r in rows.orderBy("position").collect()]
    assert found == [(uid(1, 1), uid(7, 5), None), (None, uid(7, 5), None), (None, uid(7, 5), "malformed id"), (uid(1, 2), uid(7, 5), None)]

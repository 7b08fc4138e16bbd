"""Jobs of a tenant run: changed parents, charges, active accounts, resumed chunks, streams, the run log."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.watermark import get_watermark
from ledgerlake.plans import jobs, loads
from ledgerlake.plans.registry import MODELS
from ledgerlake.sources import tables
from ledgerlake.sources.tables import committed, keyed, read, source, table_name

NOW = datetime(2024, 6, 1, 12)
LOAD = loads.load_entity


def uid(kind, n):
    return f"{kind:08d}-0000-4000-8000-{n:012d}"


def landed(spark, rows):
    data = [(json.dumps(r), k, p) for k, (p, r) in enumerate(rows)]
    return spark.createDataFrame(data, "item string, position int, parent_id string")


def parents(spark, tenant, name, rows, now=NOW):
    items = spark.createDataFrame([(json.dumps(r), k) for k, r in enumerate(rows)], "item string, position int")
    loads.load_entity(spark, tenant, name, items, now)


def ids(spark, tenant, name, *columns):
    return sorted(tuple(r) for r in source(spark, tenant, name).select("id", *columns).collect())


def test_details_follow_the_parents_that_changed(spark, tenant):
    sale = lambda n, day: {"id": uid(1, n), "data_alteracao": f"2024-05-{day:02d}T00:00:00"}
    parents(spark, tenant, "vendas", [sale(1, 1), sale(2, 2)])
    details = lambda v: landed(spark, [(uid(1, n), {"valor_bruto": v}) for n in (1, 2, 3)])
    count, _ = jobs.load_details(spark, tenant, "vendas_detalhe", details(5), NOW)
    assert count == 2 and [r[0] for r in ids(spark, tenant, "vendas_detalhe")] == [uid(1, 1), uid(1, 2)]
    mark = get_watermark(read(spark, loads.ensure_state(spark, tenant)), tenant, loads.SOURCE, "vendas_detalhe")
    assert mark["value"].startswith("2024-05-02")  # the parent's: the details have no change time
    parents(spark, tenant, "vendas", [sale(1, 9)])
    assert jobs.load_details(spark, tenant, "vendas_detalhe", details(7), NOW)[0] == 1
    assert [(r[0], int(r[1])) for r in ids(spark, tenant, "vendas_detalhe", "valor_bruto")] == [(uid(1, 1), 7), (uid(1, 2), 5)]
    assert jobs.load_details(spark, tenant, "vendas_detalhe", details(9), NOW)[0] == 0


def test_details_are_the_same_whichever_join_takes_them(spark, tenant, monkeypatch):
    sale = lambda n, day: {"id": uid(1, n), "data_alteracao": f"2024-05-{day:02d}T00:00:00"}
    details = lambda v: landed(spark, [(uid(1, n), {"numero": n, "valor_bruto": v}) for n in range(1, 30)])
    found = []
    for few in (0, 1000):
        for module in (jobs, tables):
            monkeypatch.setattr(module, "FEW_ROWS", few, raising=False)
        own, plans = f"{tenant}_{few}", []
        monkeypatch.setattr(jobs.loads, "load_entity", lambda s, t, name, items, *a, **o: plans.append(items._jdf.queryExecution().executedPlan().toString()) or LOAD(s, t, name, items, *a, **o))
        parents(spark, own, "vendas", [sale(n, 1 + n % 5) for n in range(1, 21)])
        jobs.load_details(spark, own, "vendas_detalhe", details(5), NOW)
        parents(spark, own, "vendas", [sale(n, 9) for n in range(2, 21, 10)])
        jobs.load_details(spark, own, "vendas_detalhe", details(7), NOW)
        assert [("BroadcastHashJoin" in p) for p in plans if "Join" in p] == [few > 0] * 2
        found.append(ids(spark, own, "vendas_detalhe", "numero", "valor_bruto"))
    assert found[0] == found[1]
    assert [(r[1], int(r[2])) for r in found[0]] == [(n, 7 if n % 10 == 2 else 5) for n in range(1, 21)]


def test_many_changed_parents_are_sorted_not_broadcast(spark, tenant, monkeypatch):
    monkeypatch.setattr(jobs, "FEW_ROWS", 2, raising=False)
    plans, load = [], loads.load_entity
    monkeypatch.setattr(jobs.loads, "load_entity", lambda s, t, name, items, *a, **o: plans.append(items._jdf.queryExecution().executedPlan().toString()) or load(s, t, name, items, *a, **o))
    part = lambda n, day: {"id": uid(3, n), "data_alteracao": f"2024-05-{day:02d}T00:00:00"}
    details = lambda *ns: landed(spark, [(uid(3, n), {"id": uid(7, n), "valor": n + len(plans)}) for n in ns])
    items = lambda *rows: spark.createDataFrame([(json.dumps(r),) for r in rows], "item string")
    load(spark, tenant, "parcelas_detalhe", items(*[part(n, n) for n in (1, 2, 3)]), NOW)
    assert jobs.load_details(spark, tenant, "baixas", details(1, 2, 3, 4), NOW)[0] == 3
    load(spark, tenant, "parcelas_detalhe", items(part(1, 9), part(2, 1)), NOW)  # five rows in two writes, one after the mark
    assert jobs.load_details(spark, tenant, "baixas", details(1, 2, 3, 4), NOW)[0] == 1
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
    assert "BroadcastHashJoin" in plans[1].split("Scan")[0]  # the details' join with few parents
    assert [(r[0], int(r[1])) for r in ids(spark, tenant, "baixas", "valor")] == [(uid(7, 1), 2), (uid(7, 2), 2), (uid(7, 3), 3)]


def test_instalments_have_two_kinds_of_parents(spark, tenant):
    title = lambda n, day: {"id": uid(2, n), "data_alteracao": f"2024-05-{day:02d}T00:00:00"}
    parents(spark, tenant, "contas_a_receber", [title(1, 3)])
    rows = [(uid(2, 1), {"id": uid(3, 1)}), (uid(2, 2), {"id": uid(3, 2)}), (uid(2, 1), {"id": "broken"})]
    count, rest = jobs.load_details(spark, tenant, "parcelas_detalhe", landed(spark, rows), NOW)  # payables do not exist yet
    assert count == 1 and [r["_problem"] for r in rest.collect()] == ["malformed id"]
    parents(spark, tenant, "contas_a_pagar", [title(2, 4)])
    jobs.load_details(spark, tenant, "parcelas_detalhe", landed(spark, rows), NOW)
    assert ids(spark, tenant, "parcelas_detalhe", "evento_financeiro_id") == [(uid(3, 1), uid(2, 1)), (uid(3, 2), uid(2, 2))]


def test_parents_in_two_tables_are_counted_together(spark, tenant, monkeypatch):
    title = lambda n, day: {"id": uid(2, n), "data_alteracao": f"2024-05-{day:02d}T00:00:00"}
    entity = loads.ENTITIES["parcelas_detalhe"]
    monkeypatch.setattr(jobs, "FEW_ROWS", 2)
    assert not jobs.many_due(spark, tenant, entity)  # no table yet
    parents(spark, tenant, "contas_a_receber", [title(1, 3), title(2, 3)])
    assert not jobs.many_due(spark, tenant, entity)  # payables do not exist yet
    parents(spark, tenant, "contas_a_pagar", [title(3, 4)])
    assert jobs.many_due(spark, tenant, entity)
    jobs.load_details(spark, tenant, "parcelas_detalhe", landed(spark, [(uid(2, n), {"id": uid(3, n)}) for n in (1, 2, 3)]), NOW)
    assert len(ids(spark, tenant, "parcelas_detalhe")) == 3
    assert not jobs.many_due(spark, tenant, entity)  # none changed after the mark


def test_invoice_items_need_an_access_key(spark, tenant):
    parents(spark, tenant, "notas_fiscais", [{"id": uid(6, 1), "chave_acesso": "k1", "data_emissao": "2024-05-01T00:00:00"}, {"id": uid(6, 2)}])
    jobs.load_details(spark, tenant, "notas_fiscais_itens", landed(spark, [("k1", {"codigo": "a"}), ("k2", {"codigo": "b"})]), NOW)
    assert [r[1:] for r in ids(spark, tenant, "notas_fiscais_itens", "chave_acesso", "nota_fiscal_id")] == [("k1", uid(6, 1))]


def test_charges_are_those_that_records_name(spark, tenant):
    assert jobs.load_charges(spark, tenant, landed(spark, [(uid(4, 1), {})]), NOW)[0] == 0
    parents(spark, tenant, "contas_a_receber", [{"id": uid(2, 1), "x": {"cobrancas": [{"id": uid(4, 1)}]}}, {"id": uid(2, 2)}])
    rows = [(uid(4, n), {"valor": n}) for n in (1, 2)]
    assert jobs.load_charges(spark, tenant, landed(spark, rows), NOW)[0] == 1
    assert ids(spark, tenant, "cobrancas") == [(uid(4, 1),)]


def test_balances_of_active_accounts_only(spark, tenant):
    account = lambda n, active: {"id": uid(5, n), "nome": "a", "ativo": active}
    parents(spark, tenant, "contas_financeiras", [account(1, True), account(2, False), account(3, None)])
    rows = landed(spark, [(uid(5, n), {"saldo_atual": n}) for n in range(1, 5)])
    jobs.load_balances(spark, tenant, rows, NOW)
    assert sorted(r[1] for r in ids(spark, tenant, "saldo_atual", "conta_financeira_id")) == [uid(5, 1), uid(5, 3)]


def test_chunks_resume_at_the_first_open_one(spark, tenant):
    asked = []

    def fetch(first, last, broken=None):
        asked.append(first)
        if len(asked) == broken:
            raise OSError("no answer")
        day = {"id": uid(6, first.toordinal()), "data_emissao": f"{last}T00:00:00"}
        return spark.createDataFrame([(json.dumps(day), 0)], "item string, position int")

    now = datetime(2024, 3, 1)
    entity = loads.ENTITIES["notas_servico"]
    with pytest.raises(OSError):
        jobs.load_chunks(spark, tenant, "notas_servico", lambda a, b: fetch(a, b, 3), now, "r1")
    assert len(asked) == 3 and source(spark, tenant, "notas_servico").count() == 2
    again = jobs.load_chunks(spark, tenant, "notas_servico", fetch, now, "r1")
    total = source(spark, tenant, "notas_servico").count()
    assert asked[3] == asked[2] and total == 2 + len(again)
    assert again[-1][1] == now.date() and asked[0] == now.date() - timedelta(days=entity.options["look_back"])
    assert jobs.load_chunks(spark, tenant, "notas_servico", fetch, now, "r1") == []


def test_landed_pages_as_a_stream(spark, tenant, tmp_path):
    pages = tmp_path / "landed"
    pages.mkdir()
    put = lambda name, *rows: (pages / name).write_text(json.dumps({"itens": list(rows)}))
    put("1.json", {"id": uid(1, 1), "numero": 1, "data_alteracao": "2024-05-01T00:00:00"}, {"id": "bad"})
    run = lambda: jobs.stream_load(jobs.stream_pages(spark, str(pages)), tenant, "vendas", str(tmp_path / "progress"), lambda: NOW).awaitTermination()
    run()
    put("2.json", {"id": uid(1, 1), "numero": 5, "data_alteracao": "2024-05-03T00:00:00"}, {"numero": 7})
    run()
    run()
    assert ids(spark, tenant, "vendas", "numero") == [(uid(1, 1), 5)]
    set_aside = read(spark, table_name(tenant, "raw", "quarantine_vendas"))
    assert sorted(r["problem"] for r in set_aside.collect()) == ["malformed id", "missing id"]
    assert get_watermark(read(spark, loads.ensure_state(spark, tenant)), tenant, loads.SOURCE, "vendas")["value"].startswith("2024-05-03")
    table = keyed(spark, table_name(tenant, "raw", "vendas"))
    assert len(committed(spark, table["folder"])) == 2


def test_a_run_goes_parents_first_and_is_logged(spark, tenant):
    items = lambda *rows: spark.createDataFrame([(json.dumps(r), k) for k, r in enumerate(rows)], "item string, position int")
    given = {
        "baixas": landed(spark, [(uid(3, 1), {"id": uid(7, 1), "valor": 2})]),
        "parcelas_detalhe": landed(spark, [(uid(2, 1), {"id": uid(3, 1), "data_alteracao": "2024-05-02T00:00:00"})]),
        "contas_a_receber": items({"id": uid(2, 1), "data_alteracao": "2024-05-01T00:00:00"}),
        "vendedores": items({"id": "broken", "nome": "x"}),
    }
    assert jobs.in_order(given) == ["contas_a_receber", "parcelas_detalhe", "baixas", "vendedores"]
    with pytest.raises(Exception, match="unusable item"):  # a list stops at a record it cannot use
        jobs.load_run(spark, tenant, given, NOW, "r1")
    assert ids(spark, tenant, "baixas", "parcela_id") == [(uid(7, 1), uid(3, 1))]
    log = {r["task_id"]: r for r in read(spark, table_name(tenant, "raw", "run_log")).collect()}
    assert {k: (r["status"], r["rows_inserted"]) for k, r in log.items()} == {
        "load.contas_a_receber": ("success", 1), "load.parcelas_detalhe": ("success", 1), "load.baixas": ("success", 1),
        "load.vendedores": ("failed", None),
    }
    assert "unusable item" in log["load.vendedores"]["error_message"]


def test_models_read_what_came_after_their_mark(spark, tenant):
    product = lambda n, name: {"id": uid(8, n), "nome": name, "data_alteracao": f"2024-05-{n:02d}T00:00:00"}
    parents(spark, tenant, "produtos", [product(n, "old") for n in range(1, 5)])
    loads.build_models(spark, tenant, ["stg_produtos"], NOW)
    parents(spark, tenant, "produtos", [{**product(2, "new"), "data_alteracao": "2024-05-20T00:00:00"}], NOW - timedelta(days=3))  # an earlier clock
    loads.build_models(spark, tenant, ["stg_produtos"], NOW + timedelta(hours=1))
    table = read(spark, table_name(tenant, "staging", "stg_produtos"))
    name = "nome" if "nome" in table.columns else [c for c in table.columns if "nome" in c][0]
    assert sorted(r[name] for r in table.collect()) == ["new", "old", "old", "old"]
    state = read(spark, loads.ensure_state(spark, tenant))
    assert get_watermark(state, tenant, loads.MODEL_MARKS, "stg_produtos<produtos")["value"] == "2"
    assert MODELS["stg_produtos"].mode == "incremental"
    assert state.where(F.col("source") == loads.MODEL_MARKS).count() == 1

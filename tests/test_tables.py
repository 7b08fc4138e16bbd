"""Keyed tables on storage: appended writes, idempotent reruns, compaction, schema growth."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.sources import tables

COLUMNS = {"id": "string", "v": "int", "created": "string", "loaded_at": "timestamp"}


@pytest.fixture
def table(spark, tenant):
    tables.ensure_database(spark, tenant, "raw")
    name = tables.table_name(tenant, "raw", "things")
    tables.ensure_table(spark, name, COLUMNS, ["id"], 8)
    return name


def rows(spark, name):
    return sorted(tuple(r) for r in tables.read(spark, name).select("id", "v", "created").collect())


def batch(spark, data):
    return spark.createDataFrame(data, "id string, v int, created string")


def test_upsert_inserts_updates_and_keeps_insert_only_columns(spark, table):
    first = datetime(2024, 1, 1)
    tables.upsert_table(spark, table, batch(spark, [("a", 1, "x"), ("b", 2, None)]), ["id"], loaded_at=first)
    second = datetime(2024, 1, 2)
    tables.upsert_table(
        spark, table, batch(spark, [("b", 5, "late"), ("c", 3, "y")]), ["id"], insert_only=["created"], loaded_at=second
    )
    assert rows(spark, table) == [("a", 1, "x"), ("b", 5, None), ("c", 3, "y")]
    stamps = {r["id"]: r["loaded_at"] for r in tables.read(spark, table).collect()}
    assert stamps["a"] == first and stamps["b"] == second and stamps["c"] == second


def test_rerun_changes_nothing(spark, table):
    data = batch(spark, [(str(i), i, "x") for i in range(50)])
    for _ in range(2):
        tables.upsert_table(spark, table, data, ["id"], insert_only=["created"], loaded_at=datetime(2024, 1, 1))
    assert len(rows(spark, table)) == 50


def files(spark, name):
    found = tables.keyed(spark, name)
    rows, _ = tables.history(spark, found)
    return {r[0] for r in rows.select("_metadata.file_path").distinct().collect()}


def test_a_write_rewrites_nothing(spark, table):
    tables.upsert_table(
        spark, table, batch(spark, [(str(i), i, "x") for i in range(200)]), ["id"], loaded_at=datetime(2024, 1, 1)
    )
    before = files(spark, table)
    tables.upsert_table(spark, table, batch(spark, [("7", 700, "x")]), ["id"], loaded_at=datetime(2024, 1, 2))
    after = files(spark, table)
    assert before < after and len(after - before) == 1
    assert len(rows(spark, table)) == 200 and ("7", 700, "x") in rows(spark, table)


def test_compaction_keeps_rows_and_the_readers_of_the_old_folder(spark, table):
    for day in (1, 2, 3):
        data = batch(spark, [(str(i), 10 * day + i, f"c{day}") for i in range(day, 20)])
        tables.upsert_table(spark, table, data, ["id"], insert_only=["created"], loaded_at=datetime(2024, 1, day))
    old, before = tables.read(spark, table), rows(spark, table)
    tables.compact_table(spark, table)
    assert rows(spark, table) == before and len(tables.committed(spark, tables.keyed(spark, table)["folder"])) == 1
    assert sorted(tuple(r) for r in old.select("id", "v", "created").collect()) == before  # its files are still there
    tables.upsert_table(spark, table, batch(spark, [("5", 0, "late"), ("z", 1, "new")]), ["id"], loaded_at=datetime(2024, 1, 4))
    assert rows(spark, table) == sorted([("5", 0, "c1") if r[0] == "5" else r for r in before] + [("z", 1, "new")])


def test_a_write_without_success_marker_does_not_exist(spark, table):
    tables.upsert_table(spark, table, batch(spark, [("a", 1, "x")]), ["id"], loaded_at=datetime(2024, 1, 1))
    folder = tables.keyed(spark, table)["folder"]
    lost = batch(spark, [("a", 9, "x"), ("b", 9, "x")]).selectExpr("*", "timestamp'2024-01-02' loaded_at", "2L _change", "date'2024-01-02' load_date")
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    lost.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("load_date").parquet(f"{folder}/change_batch={2:020d}-upsert")
    spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows(spark, table) == [("a", 1, "x")]


def test_changes_after_a_mark_prune_folders(spark, table):
    for day in (1, 2):
        tables.upsert_table(spark, table, batch(spark, [(str(i), day, "x") for i in range(day * 3)]), ["id"], loaded_at=datetime(2024, 1, day))
    first = tables.changed_after(spark, table, 1)
    assert sorted(r["id"] for r in first.collect()) == [str(i) for i in range(6)]
    tables.upsert_table(spark, table, batch(spark, [("1", 7, "x")]), ["id"], loaded_at=datetime(2024, 1, 3))
    later = tables.changed_after(spark, table, tables.last_change(spark, table) - 1)
    assert [(r["id"], r["v"]) for r in later.collect()] == [("1", 7)]
    plan = later._jdf.queryExecution().executedPlan().toString()
    pruned = [line for line in plan.splitlines() if "PartitionFilters" in line and "change_batch" in line.split("PartitionFilters")[1].split("PushedFilters")[0]]
    assert pruned
    tables.compact_table(spark, table)
    assert tables.changed_after(spark, table, tables.last_change(spark, table)).count() == 0
    assert tables.changed_after(spark, table, 2).count() == 1


def test_replayed_micro_batch_appends_nothing(spark, table):
    data = batch(spark, [("a", 1, "x")])
    assert tables.upsert_table(spark, table, data, ["id"], loaded_at=datetime(2024, 1, 1), replay=("s", 4))
    before = files(spark, table)
    assert not tables.upsert_table(spark, table, data, ["id"], loaded_at=datetime(2024, 1, 2), replay=("s", 4))
    tables.compact_table(spark, table)
    assert not tables.upsert_table(spark, table, data, ["id"], loaded_at=datetime(2024, 1, 2), replay=("s", 4))
    assert tables.upsert_table(spark, table, data, ["id"], loaded_at=datetime(2024, 1, 2), replay=("s", 5))
    assert len(before) == 1 and rows(spark, table) == [("a", 1, "x")]


def test_nested_fields_grow(spark, tenant):
    tables.ensure_database(spark, tenant, "raw")
    name = tables.table_name(tenant, "raw", "nested")
    tables.ensure_table(spark, name, {"id": "string", "p": "struct<a:int>", "l": "array<struct<x:int>>"}, ["id"])
    tables.upsert_table(spark, name, spark.sql("select 'a' id, named_struct('a', 1) p, array(named_struct('x', 1)) l"), ["id"])
    tables.upsert_table(
        spark, name, spark.sql("select 'b' id, named_struct('b', 'new', 'a', 2) p, array(named_struct('x', 2, 'y', named_struct('z', 3))) l"), ["id"]
    )
    tables.upsert_table(spark, name, spark.sql("select 'c' id, array(named_struct('x', 5)) l"), ["id"])
    got = {r["id"]: r for r in tables.read(spark, name).collect()}
    assert (got["a"]["p"]["a"], got["a"]["p"]["b"], got["a"]["l"][0]["y"]) == (1, None, None)
    assert (got["b"]["p"]["a"], got["b"]["p"]["b"], got["b"]["l"][0]["y"]["z"]) == (2, "new", 3)
    assert got["c"]["p"] is None and got["c"]["l"][0]["y"] is None
    with pytest.raises(ValueError, match="cannot take"):
        tables.upsert_table(spark, name, spark.sql("select 'd' id, 'text' p"), ["id"])


def test_a_child_that_moves_leaves_its_old_parent(spark, tenant):
    tables.ensure_database(spark, tenant, "raw")
    name = tables.table_name(tenant, "raw", "moving")
    tables.ensure_table(spark, name, {"p": "string", "id": "string"}, ["p"], unique=["id"])
    kids = lambda *pairs: tables.replace_children_table(spark, name, spark.createDataFrame(pairs, "p string, id string"), "p")
    got = lambda: sorted(tuple(r) for r in tables.read(spark, name).select("p", "id").collect())
    kids(("a", "1"), ("a", "2"), ("b", "3"))
    kids(("b", "2"), ("b", "3"))
    assert got() == [("a", "1"), ("b", "2"), ("b", "3")]
    tables.compact_table(spark, name)
    kids(("a", "3"),)
    assert got() == [("a", "3"), ("b", "2")]
    kids(("a", "1"),)  # 3 left b, and is gone from a
    assert got() == [("a", "1"), ("b", "2")]


def test_null_key_raises(spark, table):
    with pytest.raises(Exception, match="NULL in key column id"):
        tables.upsert_table(spark, table, batch(spark, [(None, 1, "x")]), ["id"], loaded_at=datetime(2024, 1, 1))


def test_last_row_of_a_key_in_a_batch_counts(spark, table):
    data = spark.createDataFrame(
        [("a", 1, "x", 1), ("a", 2, "x", 2), ("a", 3, "x", 0)], "id string, v int, created string, position int"
    )
    tables.upsert_table(spark, table, data, ["id"], ["position"], loaded_at=datetime(2024, 1, 1))
    assert rows(spark, table)[0][1] == 2


def test_new_columns_are_appended(spark, tenant):
    tables.ensure_database(spark, tenant, "staging")
    name = tables.table_name(tenant, "staging", "m")
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    tables.materialize(old, name, "incremental", key="k", buckets=4)
    new = spark.createDataFrame([("b", 2, "extra")], "k string, v int, w string")
    tables.materialize(new, name, "incremental", key="k", buckets=4)
    got = sorted(tuple(r) for r in tables.read(spark, name).select("k", "v", "w").collect())
    assert got == [("a", 1, None), ("b", 2, "extra")]


def test_children_are_replaced_per_parent(spark, tenant):
    tables.ensure_database(spark, tenant, "raw")
    name = tables.table_name(tenant, "raw", "kids")
    tables.ensure_table(spark, name, {"p": "string", "n": "int"}, ["p"], 4)
    kids = lambda data: spark.createDataFrame(data, "p string, n int")
    tables.replace_children_table(spark, name, kids([("a", 1), ("a", 2), ("b", 1)]), "p")
    tables.replace_children_table(spark, name, kids([("a", 9)]), "p")
    tables.replace_children_table(spark, name, kids([]), "p")
    got = sorted(tuple(r) for r in tables.read(spark, name).select("p", "n").collect())
    assert got == [("a", 9), ("b", 1)]


def test_view_and_table_modes(spark, tenant):
    tables.ensure_database(spark, tenant, "delivery")
    df = spark.range(3).withColumn("x", F.lit("a"))
    for mode in ("view", "table"):
        name = tables.table_name(tenant, "delivery", f"m_{mode}")
        tables.materialize(df, name, mode, drop_first=True)
        tables.materialize(df.drop("x"), name, mode, drop_first=True)
        assert tables.ref(spark, name).columns == ["id"]
        assert tables.ref(spark, name).count() == 3


def test_a_table_of_one_write_is_read_as_it_is(spark, tenant):
    tables.ensure_database(spark, tenant, "raw")
    name = tables.table_name(tenant, "raw", "lines")
    tables.ensure_table(spark, name, {"id": "string", "up": "string"}, ["up"], unique=["id"])
    tables.append(spark, name, spark.createDataFrame([("a", "p"), ("b", "p"), ("c", None)], "id string, up string"))
    found = tables.read(spark, name)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert sorted(map(tuple, found.collect()), key=str) == [("a", "p"), ("b", "p"), ("c", None)]


def test_rows_of_the_first_write_do_not_tell_which_write_is_the_last(spark, table):
    for day, ids in ((1, range(300)), (2, range(5))):
        tables.upsert_table(spark, table, batch(spark, [(str(i), day, "x") for i in ids]), ["id"], loaded_at=datetime(2024, 1, day))
    plan = tables.read(spark, table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan[plan.index("Aggregate") :].count("change_batch") and "> 00000000000000000001-upsert" in plan
    assert [r[1] for r in sorted(rows(spark, table), key=lambda r: int(r[0]))] == [2] * 5 + [1] * 295


def test_first_values_by_one_shuffle_are_those_by_joins(spark, table):
    uuids = [f"{i:08x}-0000-4000-8000-{i:012x}" for i in range(20)]
    ids = [*uuids, *[u.upper() for u in uuids[10:]], "x", "", f"{uuids[1]}\n", uuids[2].replace("-", "")]
    for day, some in ((1, ids[5:]), (2, ids[::2]), (3, ids[::3])):
        data = [(k, day, f"c{day}" if n % 4 else None) for n, k in enumerate(some)]
        tables.upsert_table(spark, table, batch(spark, data), ["id"], insert_only=["created"], loaded_at=datetime(2024, 1, day))
    found = tables.keyed(spark, table)
    by = {much: tables._current(spark, found, much=much) for much in (0, 1e9)}
    assert "Window" in by[0]._jdf.queryExecution().executedPlan().toString()
    once, joined = (sorted(tuple(r) for r in by[m].select("id", "v", F.coalesce("created", F.lit("-")), "loaded_at", "_change", "load_date").collect()) for m in (0, 1e9))
    assert once == joined and len(once) == len({*ids[5:], *ids[::2], *ids[::3]})


@pytest.mark.parametrize("insert_only", [(), ("created",)])
def test_keys_of_many_later_rows_are_sorted_not_broadcast(spark, table, monkeypatch, insert_only):
    monkeypatch.setattr(tables, "FEW_ROWS", 4, raising=False)
    for day, n in ((1, 300), (2, 3), (3, 2)):
        tables.upsert_table(spark, table, batch(spark, [(str(i), day, f"c{day}") for i in range(n)]), ["id"], insert_only=insert_only, loaded_at=datetime(2024, 1, day))
    found = tables._current(spark, tables.keyed(spark, table), much=1e9)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    monkeypatch.setattr(tables, "FEW_ROWS", 5)
    few = tables._current(spark, tables.keyed(spark, table), much=1e9)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    for df in (found, few):
        got = sorted((int(r["id"]), r["v"], r["created"]) for r in df.collect())
        days = [3, 3, 2, *[1] * 297]
        assert got == [(i, v, "c1" if insert_only else f"c{v}") for i, v in enumerate(days)]


def test_all_rows_are_those_of_every_write(spark, table):
    for day in (1, 2):
        tables.upsert_table(spark, table, batch(spark, [("a", day, "x")]), ["id"], loaded_at=datetime(2024, 1, day))
    assert tables.all_rows(spark, table).count() == 2 and tables.read(spark, table).count() == 1


def test_packed_ids_are_unpacked_in_one_go(spark):
    ids = ["0123abcd-4567-89ab-cdef-0123456789ab", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    text = tables._uuid_of(F.unhex(F.translate("id", "-", "")))
    assert [r[0] for r in df.select(text).collect()] == ids
    plan = df.select(text.alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("unhex(") == 1

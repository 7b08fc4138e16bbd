"""Properties of the operators, against brute force on small data."""

import itertools
import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import changes, quality, ranking, runlog, watermark, windows
from ledgerlake.operators.upsert import latest_by, latest_by_few, upsert
from ledgerlake.sources import pages
from ledgerlake.sources import tables
from ledgerlake.streaming.ingest import stream_files, stream_upsert


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_is_idempotent_and_ignores_arrival_order(spark):
    rng = random.Random(7)
    data = [(rng.randrange(20), rng.randrange(100), n) for n in range(200)]
    data += [(3, rng.randrange(100), 500 + n) for n in range(100)]  # one hot key
    schema = "k int, v int, seq int"
    want = {}
    for k, v, seq in sorted(data, key=lambda r: r[2]):
        want[k] = (k, v, seq)
    empty = spark.createDataFrame([], schema)
    for shuffled in (data, data[::-1], rng.sample(data, len(data))):
        once = upsert(empty, spark.createDataFrame(shuffled, schema), ["k"], ["seq"])
        twice = upsert(once, spark.createDataFrame(shuffled, schema), ["k"], ["seq"])
        assert rows(once) == rows(twice) == sorted(want.values(), key=str)


def test_batches_applied_in_order_equal_one_large_batch(spark):
    data = [(n % 7, n, n) for n in range(60)]
    schema = "k int, v int, seq int"
    table = spark.createDataFrame([], schema)
    for start in range(0, 60, 20):
        table = upsert(table, spark.createDataFrame(data[start : start + 20], schema), ["k"], ["seq"])
    assert rows(table) == rows(latest_by(spark.createDataFrame(data, schema), ["k"], ["seq"]))


def test_latest_by_reduces_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = latest_by(df, ["k"], ["v"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") >= 2 and physical.rindex("WindowGroupLimit") > physical.index("Exchange")


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("span", [0, 1, 15, 16, 17, 32, 365])
def test_date_chunks_cover_every_day_once(spark, span, inclusive):
    start = date(2024, 1, 1)
    end = start + timedelta(days=span)
    starts = [start + timedelta(days=16 * i) for i in range(span // 16 + 1)]
    want = [(i, s, min(s + timedelta(days=15), end)) for i, s in enumerate(starts) if inclusive or s < end]
    assert [tuple(r) for r in windows.date_chunks(spark, start, end, 15, inclusive).orderBy("chunk").collect()] == want


def shown(value):
    """Ids are text or numbers; an object in an id's place shows as JSON."""
    return json.dumps(value, separators=(",", ":"), sort_keys=True) if isinstance(value, (dict, list)) else str(value)


def named_ids(key, value):
    """The ids a field names, or None if its value is to be searched."""
    match key, value:
        case "cobranca", {"id": i} if i:
            return [i]
        case "cobrancas", list():
            return [x["id"] for x in value if isinstance(x, dict) and x.get("id")]
        case "id_cobranca", v if v:
            return [v]
    return None


def brute_scan(payload):
    found, open_values = set(), [payload]
    while open_values:
        value = open_values.pop()
        fields = value.items() if isinstance(value, dict) else [(None, v) for v in value] if isinstance(value, list) else []
        for key, inner in fields:
            ids = named_ids(key, inner)
            found.update(shown(i) for i in ids or [])
            if ids is None:
                open_values.append(inner)
    return found


def test_scan_ids_equals_brute_force(spark):
    rng = random.Random(3)

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind < 2:
            return rng.choice(["", "x", "0", 0, 5, None, False, "i%d" % rng.randrange(30)])
        if kind == 2:
            return []
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        keys = ["cobranca", "cobrancas", "id", "a", "b"]
        out = {rng.choice(keys): value(depth - 1) for _ in range(rng.randrange(4))}
        if rng.random() < 0.3:
            out["id_cobranca"] = rng.choice(["", None, "d%d" % rng.randrange(30), 9])
        return out

    docs = [value(5) for _ in range(400)]
    want = set(itertools.chain.from_iterable(brute_scan(d) for d in docs))
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "raw string")
    assert {r["id"] for r in changes.scan_ids(df, "raw").collect()} == want


def test_scan_ids_fails_loudly_when_nested_too_deep(spark):
    deep = json.dumps({"a": {"a": {"a": {"id_cobranca": "x"}}}})
    df = spark.createDataFrame([(deep,)], "raw string")
    assert changes.scan_ids(df, "raw", max_depth=5).count() == 1
    with pytest.raises(Exception, match="nested deeper"):
        changes.scan_ids(df, "raw", max_depth=2).collect()


def test_scan_ids_has_no_depth_of_its_own(spark):
    deep: object = {"id_cobranca": "x", "t": 'a "{[" in a text'}
    for _ in range(12):
        deep = {"a": [deep]}
    df = spark.createDataFrame([(json.dumps(deep),), ('{"id_cobranca": "y"}',), (None,)], "raw string")
    assert {r["id"] for r in changes.scan_ids(df, "raw").collect()} == {"x", "y"}
    assert changes.scan_ids(df.limit(0), "raw").count() == 0


def test_with_parent_keeps_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    parent = spark.createDataFrame([(1, "p")], "k int, w string")
    assert sorted(tuple(r) for r in changes.with_parent(child, parent, ["k"], ["w"]).collect()) == [(1, "a", "p"), (2, "b", None)]


def test_upsert_without_order_has_one_row_per_key(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    assert sorted(tuple(r) for r in upsert(target, batch, ["k"]).collect()) == [(1, "y"), (2, "z")]


def test_global_row_number(spark):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 1000 as v")
    got = ranking.global_row_number(df, [F.col("v").desc()], "seq", partitions=5)
    assert [tuple(r) for r in got.orderBy("seq").select("seq", "v").collect()] == [(i + 1, 999 - i) for i in range(1000)]


def test_windows_and_cursor(spark):
    now = datetime(2024, 6, 1, 10, 0, 0, 999)
    assert watermark.window_bounds(now, None) == (datetime(2024, 5, 2, 10), datetime(2024, 6, 1, 10))
    since, _ = watermark.window_bounds(now, {"value": "2024-05-05T01:02:03.5Z"})
    assert since == datetime(2024, 5, 5, 1, 2, 3)
    assert watermark.watermark_row(spark, "t", "s", "e", None, 0, None, now) is None


def test_page_envelopes(spark):
    bodies = [
        '{"itens":[{"id":1}],"itens_totais":9}', '{"items":[{"id":2}],"totalItems":9}', '{"dados":[{"id":3}],"total_itens":9}',
        '{"data":[{"id":4}],"paginacao":{"total_itens":9}}', '[{"id":5}]', '{"itens":null,"data":[{"id":6}]}',
        '{"outros":[{"id":7}],"total":9}', '{"itens":[],"total":"x"}',
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "n int, body string")
    got = [(r["n"], r["item"]) for r in pages.unwrap_pages(df).orderBy("n").collect()]
    assert got == [(i, '{"id":%d}' % (i + 1)) for i in range(5)]
    totals = [r["announced"] for r in pages.open_pages(df).orderBy("n").collect()]
    assert totals == [9, 9, 9, 9, None, None, 9, None]
    one = spark.createDataFrame([('{"razao_social":"x"}',)], "body string")
    assert pages.unwrap_pages(one, "single").first()["item"] == '{"razao_social":"x"}'


def test_landed_files_are_read_whole(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"itens":\n[{"id":1},\n{"id":2}]}')
    (tmp_path / "p2.json").write_text('[{"id":3}]')
    items = pages.unwrap_pages(pages.read_pages(spark, str(tmp_path)))
    assert sorted(json.loads(r["item"])["id"] for r in items.collect()) == [1, 2, 3]


def test_repeated_and_short_pages(spark):
    data = [("a", 1, '{"itens":[{"id":1},{"id":2}],"total":2}'), ("a", 2, '{"itens":[{"id":1},{"id":2}],"total":2}'), ("b", 1, '{"itens":[{"id":1},{"x":2}],"total":5}'), ("c", 1, '{"itens":[]}')]
    df = spark.createDataFrame(data, "endpoint string, page int, body string")
    got = {r["endpoint"]: (r["pages"], r["expected"], r["received"], r["distinct_items"], r["missing"], r["status"]) for r in pages.reconcile_pages(df).collect()}
    assert got == {"a": (2, 2, 4, 2, 0, "repeated"), "b": (1, 5, 2, 1, 4, "short"), "c": (1, None, 0, 0, None, "unknown")}


def test_checks_take_one_aggregate_pass(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "k int, s string")
    checks = [quality.not_null("s"), quality.accepted("s", ("a",), "warn"), quality.not_null("k"), quality.unique("k")]
    got = {r["check_name"]: (r["failures"], r["status"]) for r in quality.run_checks(df, "t", checks).collect()}
    assert got == {
        "not_null_s": (1, "fail"), "accepted_values_s": (1, "warn"), "not_null_k": (0, "pass"), "unique_k": (1, "fail"),
    }


def test_run_log_keeps_errors_and_counts_writes(spark):
    task = ("r1", "load", 2, "failed", datetime(2024, 1, 1), datetime(2024, 1, 2), 1, 2, 3, "e" * 5000)
    schema = "run_id string, task_id string, map_index int, status string, started_at timestamp, finished_at timestamp, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, error string"
    row = runlog.task_log(spark.createDataFrame([task], schema)).first()
    assert row["external_run_id"] == "r1::load[2]" and len(row["error_message"]) == 5000
    assert len(runlog.task_log(spark.createDataFrame([task], schema), 4000).first()["error_message"]) == 4000
    df, seen = runlog.counted(spark.range(17), "written")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 17


def test_stream_reads_each_file_once(spark, tenant, tmp_path):
    tables.ensure_database(spark, tenant, "raw")
    name = tables.table_name(tenant, "raw", "s")
    tables.ensure_table(spark, name, {"id": "string", "v": "int"}, ["id"], 2)
    land, progress = tmp_path / "in", str(tmp_path / "progress")
    land.mkdir()

    def run():
        stream = stream_files(spark, str(land), "id string, v int")
        stream_upsert(stream, name, ["id"], progress, ["v"]).awaitTermination()
        return rows(tables.read(spark, name).select("id", "v"))

    (land / "a.json").write_text('{"id":"x","v":1}\n{"id":"x","v":3}\n{"id":"y","v":2}')
    assert run() == [("x", 3), ("y", 2)]
    (land / "b.json").write_text('{"id":"x","v":2}')
    assert run() == [("x", 2), ("y", 2)]
    assert run() == [("x", 2), ("y", 2)]


def test_scan_ids_in_rounds(spark):
    """Records of depth 900 among shallow ones; hits at every border between two rounds."""
    def nested(depth, last):
        return '{"a":' * depth + last + "}" * depth

    records = [nested(d, '{"id_cobranca":"d%d"}' % d) for d in (0, 9, 10, 11, 12, 13, 22, 23, 24, 25, 300, 900)]
    records += ['{"cobranca":{"id":"x"}}', '[]', "null", "7", '"text"'] * 50
    df = spark.createDataFrame([(r,) for r in records], "raw string")
    got = sorted(r["id"] for r in changes.scan_ids(df, "raw").collect())
    assert got == sorted([f"d{d}" for d in (0, 9, 10, 11, 12, 13, 22, 23, 24, 25, 300, 900)] + ["x"])


def test_pages_end_at_the_first_repeat(spark):
    body = lambda *ids: json.dumps({"itens": [{"id": i} for i in ids], "itens_totais": 4})
    rows = [
        ("a", 1, body(1, 2)), ("a", 2, body(3, 4)), ("b", 1, body(1, 2)), ("b", 2, body(2, 1)), ("b", 3, body(3, 4)),
        ("c", 1, body()), ("c", 2, body()), ("d", 1, '{"itens":[{"id":9}]}'),
    ]
    df = spark.createDataFrame(rows, "endpoint string, page int, body string")
    kept = sorted((r["endpoint"], r["page"]) for r in pages.until_repeat(df).collect())
    assert kept == [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("d", 1)]
    whole, short = pages.complete_endpoints(df)
    assert sorted({r["endpoint"] for r in whole.collect()}) == ["a", "d"]
    assert sorted((r["endpoint"], r["missing"]) for r in short.collect()) == [("b", 2), ("c", 4)]


def test_only_rows_of_repeated_keys_are_ranked(spark):
    data = [(k, v, "t") for k in range(40) for v in range(1 + (k % 10 == 3))] + [(None, 1, "a"), (None, 2, "b")]
    df = spark.createDataFrame(data, "k int, v int, t string")
    wanted = rows(latest_by(df, ["k"], ["v"]))
    for few in (0, 3, 400):
        assert rows(latest_by_few(df, ["k"], ["v"], few)) == wanted
    once = latest_by_few(df.where("k % 10 <> 3"), ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in once and "Exchange" not in once

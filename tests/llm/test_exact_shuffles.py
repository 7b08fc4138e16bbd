"""The rows that stay are numbered where the join has put them: no text moves once more for it."""

from ledgerlake.llm import exact


def test_rows_that_stay_are_not_shuffled_again(spark):
    data = [(1, "a  b", "x"), (1, "a b", "w"), (None, "c", "y"), (None, "c", "x"), (2, "a b", "z"), (0, "d", "v"), (3, "c", "u"), (None, None, "t")]
    docs = spark.createDataFrame(data, "doc_id int, text string, source string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = exact.first_of_groups(docs)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[plan.index("Window") : plan.index("Join")]
        kept = sorted(map(tuple, found.collect()), key=str)
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert kept == sorted([(1, "a  b", "x"), (None, "c", "x"), (0, "d", "v"), (None, None, "t")], key=str)

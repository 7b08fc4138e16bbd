"""Headline queries, timed one after the other: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Results go to Spark's
``noop`` sink: every row and column is computed, nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import all_queries  # noqa: E402
from checks.mapping import raw_table  # noqa: E402
from ledgerlake.session import build_session, shared_dir  # noqa: E402
from ledgerlake.sources import tables  # noqa: E402

HEADLINE = """
fin_receita_diaria fin_despesa_diaria vendas_diaria saldo_inicial clientes_resumo dre_valores dre_estrutura
fct_parcelas fct_vendas_itens dim_produtos dim_categorias_financeiras latest_by upsert_latest
upsert_insert_only delete_insert replace_children changed_keys with_parent scan_ids date_chunks
daily_snapshot page_reconcile parse_items quality_report document_audit run_rollup tenant_union
global_rank uuid5_key stream_upsert
""".split()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus != "*" else "8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = all_queries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()

    times: dict[str, float] = {}
    for name in HEADLINE:
        times[name] = timed(
            lambda q=found[name]: q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    times.update(table_merges(spark, sf_dir))
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("/", 1)[-1],
            }
        )
    )
    spark.stop()


def table_merges(spark, sf_dir: str) -> dict[str, float]:
    """A stored table of order lines: full build, then the upsert of one line in a hundred."""
    tables.ensure_database(spark, "bench", "raw", shared_dir(spark, "bench"))
    rows = raw_table(spark, sf_dir, "baixas")
    columns = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    name = tables.table_name("bench", "raw", "baixas")
    tables.ensure_table(spark, name, columns, ["id"], 8)
    build = timed(lambda: tables.upsert_table(spark, name, rows, ["id"], ["data_alteracao"]))
    landed = shared_dir(spark, "landed")
    rows.where("crc32(id) % 100 = 0").write.parquet(landed)
    batch = spark.read.parquet(landed)
    merge = timed(lambda: tables.upsert_table(spark, name, batch, ["id"], ["data_alteracao"], ["data_criacao"]))
    return {"table_full_build": build, "table_upsert_one_percent": merge}


if __name__ == "__main__":
    main()

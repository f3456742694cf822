"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores.  Every query runs over its whole tables;
writes go to a new folder each time, reads end in the ``noop`` sink so that nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.tables import every_type, folder, table  # noqa: E402
from transferkit import (  # noqa: E402
    Endpoint, column_infos, ddl, delete_statements, max_byte_length, read_staged, to_canonical, to_literals,
    to_load, transfer, upsert, write_load, write_staged,
)
from registry.catalogs import translated  # noqa: E402
from transferkit.session import workspace  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def benchmarks(spark: SparkSession) -> dict:
    line, orders = table(spark, SF_DIR, "lineitem"), table(spark, SF_DIR, "orders")
    documents, customer = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "customer")
    staged = workspace(spark, "bench_staged")
    infos = write_staged(line, staged)
    documents_staged = workspace(spark, "bench_documents")
    document_infos = write_staged(documents, documents_staged)
    changed = orders.where(F.col("o_orderdate") >= F.lit("2000-12-01").cast("timestamp_ntz"))

    def load_files(target):
        return lambda: write_load(line, workspace(spark, f"bench_{target}"), target)

    def table_transfer():
        transfer(
            spark, folder(SF_DIR), Endpoint("postgresql"), "lineitem", "sales", table="lineitem",
            load_path=workspace(spark, "bench_transfer"), client_folder="/load",
        )

    return {
        "prj1_canonical_lineitem": lambda: sink(to_canonical(line)),
        "prj1_canonical_every_type": lambda: sink(to_canonical(every_type(spark, SF_DIR))),
        "prj1_float_compat_lineitem": lambda: sink(to_canonical(line, compat=True)),
        "prj2_load_text_mssql": lambda: sink(to_load(line, "mssql")),
        "prj3_literal_oracle": lambda: sink(to_literals(line, "oracle")),
        "snk1_write_staged_lineitem": lambda: write_staged(line, workspace(spark, "bench_out")),
        "snk5_load_files_postgresql": load_files("postgresql"),
        "snk7_load_files_mssql": load_files("mssql"),
        "src8_read_staged_lineitem": lambda: sink(read_staged(spark, staged, infos, typed=True)),
        "src8_read_staged_documents": lambda: sink(
            read_staged(spark, documents_staged, document_infos, typed=True)
        ),
        "trf1_table_transfer_lineitem": table_transfer,
        "rel2_upsert_orders": lambda: sink(upsert(orders, changed, ["o_orderkey"])),
        "rel3_delete_statements": lambda: sink(
            delete_statements(customer.select("c_custkey"), "postgresql", "customer", "sales")
        ),
        "agg1_max_byte_length_lineitem": lambda: max_byte_length(line).collect(),
        "agg1_max_byte_length_documents": lambda: max_byte_length(documents).collect(),
        "cat13_ddl_oracle": lambda: sink(ddl(translated(spark, SF_DIR, "oracle", False), "oracle", True)),
        "column_infos": lambda: column_infos(line),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("transferkit-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="transferkit-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name, run in benchmarks(spark).items():
        best = None
        for _ in range(REPEATS):
            start = time.perf_counter()
            run()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 4)
    times.pop("column_infos")
    rows = table(spark, SF_DIR, "lineitem").count()
    print(
        json.dumps(
            {
                "metric": "transferkit_total",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "lineitem_rows": rows,
                "transfer_rows_per_sec": round(rows / times["trf1_table_transfer_lineitem"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Check named queries against their SQL: python -m tests.run_oracle [sf folder] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback

from pyspark.sql import SparkSession

import __spark_entry__ as entry
from tests.oracle import compare, connect


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        start, took = time.time(), 0.0
        try:
            df = entry.queries()[name](spark, folder)
            records = [tuple(r) for r in df.collect()]
            took = time.time() - start
            sql = entry.oracle_sql().get(name)
            problem = compare(df.columns, records, con, sql) if sql else f"rows only: {len(records)}"
        except Exception as e:  # noqa: BLE001
            problem = "ERROR " + "".join(traceback.format_exception_only(e))[:600]
        ok = problem is None or problem.startswith("rows only")
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} spark {took:.1f}s all {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()

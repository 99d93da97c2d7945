"""Run registered queries against their SQL: ``python -m tests.check SF_DIR [name ...]``."""

from __future__ import annotations

import sys
import time
import traceback

import __spark_entry__ as entry
from telemetry_lake.session import get_session

from .oracle import connect, differences


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problems = differences(df, con, sql[name]) if name in sql else []
            rows = "" if name in sql else f"{df.count()} rows, no SQL"
        except Exception:
            problems, rows = [traceback.format_exc(limit=4)[-1500:]], ""
        took = time.time() - start
        print(f"{'FAIL' if problems else 'ok  '} {name} {took:.1f}s {rows}", flush=True)
        for problem in problems:
            print("     ", problem, flush=True)
        if problems:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()

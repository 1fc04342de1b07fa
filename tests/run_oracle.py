"""Compare queries with their SQL from the command line: run_oracle.py FOLDER [name ...]"""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

import __spark_entry__ as entry  # noqa: E402
from compare import difference, duck  # noqa: E402
from phenomill.session import get_session, remove_scratch  # noqa: E402


def main(folder: str, names: list[str]) -> None:
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = duck(folder), entry.queries(), entry.oracle_sql()
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracle:
                problem = difference(df, con, oracle[name])
                status = "ok" if problem is None else "DIFF " + problem
            else:
                status = f"rows {df.count()} (no oracle)"
        except Exception as error:  # noqa: BLE001
            status = "FAIL " + str(error)[:600].replace("\n", " | ")
            if os.environ.get("TRACE"):
                traceback.print_exc()
        if status != "ok" or time.time() - start > 3 or len(names):
            print(f"{name:28s} {time.time() - start:6.2f}s {status[:900]}", flush=True)
    remove_scratch(spark)
    print("done", len(names or queries))


main(sys.argv[1], sys.argv[2:])

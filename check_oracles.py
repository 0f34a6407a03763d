"""Compare registered queries with their SQL in DuckDB: check_oracles.py [folder] [key ...]."""

import sys
import time

from tests.compare import compare_key, duck
from liftplan.session import build_session
from liftplan.suite.queries import ORACLES, QUERIES

if __name__ == "__main__":
    folder, keys = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), []
    for key in keys:
        started = time.time()
        try:
            problem, n = compare_key(spark, con, folder, key)
        except Exception as e:  # report and go on with the next key
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", -1
        if problem:
            bad.append(key)
        print(f"{'BAD ' if problem else 'ok  '}{key} rows={n} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(keys) - len(bad)} of {len(keys)} equal; without SQL: {sorted(set(QUERIES) - set(ORACLES))}; bad: {bad}")

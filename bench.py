"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from liftplan.session import build_session
from liftplan.suite.queries import QUERIES

# Query -> timed runs; the median counts. Each is run once before timing.
HEADLINE = {
    "agg_sum_group": 3, "agg_avg_sum_wide": 3, "jn_star_chain": 3, "jn_full_multi": 3, "win_latest_version": 3,
    "set_except_all": 3, "biz_rejected_removal": 3, "rsh_unpivot_months": 3, "biz_null_lifting_keep": 3,
    "job_plan_2022": 1, "job_movements": 1, "job_delivery_mapping": 1, "job_contract_summary": 1,
}


def seconds(spark, key: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("liftplan-bench", f"local[{cpus}]", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
                          spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key, runs in HEADLINE.items():
        if runs > 1:
            seconds(spark, key, folder)
        times[key] = round(statistics.median(seconds(spark, key, folder) for _ in range(runs)), 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

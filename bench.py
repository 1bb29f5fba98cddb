"""Time every query of the catalogue on one machine and print one line of JSON.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the number of cores. Each query is run
to its last row and its rows are thrown away. ``--plans`` adds, per query, how many file scans,
shuffles and broadcasts its plan has.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sitewind.plans.catalogue import queries  # noqa: E402
from sitewind.session import create_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def plan_counts(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().sparkPlan().toString()
    executed = df._jdf.queryExecution().executedPlan().toString()
    return {
        "scans": len(re.findall(r"FileScan", plan)),
        "shuffles": len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single)", executed)),
        "broadcasts": len(re.findall(r"BroadcastExchange", executed)),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = create_session("sitewind-bench", {
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("lineitem", "events", "supplier", "orders"):
        run(spark.read.parquet(f"{folder}/{table}.parquet"))

    seconds, plans = {}, {}
    for name, query in queries().items():
        started = time.perf_counter()
        df = query(spark, folder)
        run(df)
        seconds[name] = round(time.perf_counter() - started, 3)
        if "--plans" in sys.argv:
            plans[name] = plan_counts(df)
    result = {
        "metric": "all_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if plans:
        result["plans"] = plans
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

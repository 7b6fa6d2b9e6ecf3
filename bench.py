"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is run
once to warm up and then timed; its rows go to Spark's no-op sink, so all of them are
computed and none is collected.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tarnhouse.catalogue.all_queries import QUERIES
from tarnhouse.session import get_session

HEADLINE = [
    "sales_by_year",
    "sales_by_customer_year",
    "sales_by_colour",
    "sales_by_year_category",
    "orders_per_year",
    "daily_amount",
    "summarize_columns",
    "distinct_count",
    "rollup_subtotal",
    "top_n_ties",
    "discount_value_correct",
    "line_discount",
    "surrogate_key",
    "v_customer_delivered_to",
    "v_sales_orders",
    "fact_sales",
    "aggregate_routing",
    "scan_csv_typed",
    "scan_csv_glob",
    "unpivot_budget",
    "upsert",
    "load_full",
    "load_incremental",
    "update_then_insert",
    "run_loads",
    "run_stages",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),  # one process, one disk
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            begun = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begun, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

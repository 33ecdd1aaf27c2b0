"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated names, default all headline queries).
"""

from __future__ import annotations

import json
import os
import sys
import time

from mercadal.functions.kernel import trig_kernel
from mercadal.plans.table_queries import QUERIES
from mercadal.session import build_session

HEADLINE = [
    "sales_by_category_month", "top_categories", "monthly_running_total", "country_share",
    "country_category_pivot", "user_profile", "rfm_scores", "rfm_segments", "conversion_funnel",
    "behaviour_by_device", "dq_report_events", "dq_clean_events", "dq_report_lineitem",
    "dedup_lineitem_first", "fk_valid", "iqr_outliers", "price_quartiles", "sales_summary",
    "sales_by_part_type", "sales_by_region", "top5_products", "monthly_trend", "weekday_sales",
    "daily_report", "region_channel_pivot", "order_price_rank", "mcda_scores", "math_kernel",
    "scaling_report", "partitioned_roundtrip", "medallion_zone_rows",
]


def kernel_million(spark, _folder):
    """The published kernel workload: a million rows of 50 terms."""
    from pyspark.sql import functions as F

    return spark.range(1_000_000).select(trig_kernel(F.col("id")).alias("k"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "mercadal-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    # one untimed job so that the first query does not pay for JVM start-up
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    timings = {}
    runs = {name: QUERIES[name] for name in names}
    if not os.environ.get("BENCH_QUERIES"):
        runs["kernel_million"] = kernel_million
    for name, query in runs.items():
        started = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()

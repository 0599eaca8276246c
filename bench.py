"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores. Every query is run to the
end into a sink that drops the rows; the time includes building and planning the query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillworks.plans import load_all  # noqa: E402
from tillworks.session import build_session, remove_scratch  # noqa: E402

HEADLINE = [
    "daily_transactions", "hourly_transactions", "daily_sales_type", "daily_items", "daily_bundlings", "companywide_mitra",
    "companywide_daily", "daily_items_sales_type", "orders_to_tables", "orders_to_headers", "allocate_split_payment", "dedup_details",
    "dedup_summary", "daily_est_income", "reconcile_full_outer", "resend_guard", "income_pivot", "tito_hourly", "flag_sessions",
    "session_summary", "rider_day_summary", "distance_stats", "ondemand_order_summary", "commission_products", "commission_weekly",
    "append_new_orders", "upsert_hold_shrink", "accuracy_by_date", "completeness_4h", "stream_hourly_sales",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    queries, _ = load_all()
    spark = build_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries["valid_sales"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # JVM warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        remove_scratch(spark)
    print(json.dumps({"metric": "total_time_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

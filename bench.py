"""Times the headline queries and prints one JSON line.

``ingest`` builds and stores the canonical trade, bar and split tables from the test tables; the other
queries then read those tables, as a deployment would.
"""
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import catalog, fixtures  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = ["next_session_entry", "extract_signals", "simulate_positions", "round_trip_backtest", "stats_cuts",
            "global_totals", "monthly_flow", "company_summary", "insider_issuer_activity", "reported_holdings",
            "insider_portfolio", "dedupe_trades", "supersede_amendments", "row_issues", "cluster_buys",
            "flag_exercise_then_sale", "equity_curve_daily", "recent_per_company", "recent_tape"]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    start = time.time()
    stored = fixtures.store(spark, folder)
    times["ingest"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, stored).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

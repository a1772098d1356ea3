"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs once to warm up, then ``BENCH_RUNS`` times; the median counts.
Hand-over tables (features, alerts, message log) are tables in the real
pipeline; each is built once, before the queries, and that time is an entry of
its own (``stored_*``).
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerwatch.plans import catalog, standins  # noqa: E402
from ledgerwatch.session import build_session  # noqa: E402

HEADLINES = [
    "parse_messages", "validated_messages", "error_frequencies", "quality_flags",
    "bronze_table", "silver_table", "customer_features", "order_features",
    "hash_hmac", "masked_records", "mask_address", "encrypt_and_decrypt",
    "daily_limit_rows", "first_per_key", "flag_duplicates", "upsert_all_columns",
    "detect_account_takeover", "detect_amount_probing", "detect_merchant_collusion",
    "detect_bust_out", "risk_scores", "alert_rows",
    "daily_summary", "customer_patterns", "merchant_analytics", "stream_silver",
]


# In the order in which they read each other.
STORED = {
    "stored_message_log": standins.message_log, "stored_order_features": catalog._order_features,
    "stored_event_features": catalog._event_features, "stored_order_alerts": catalog._order_alerts,
}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINES
    spark = build_session("bench", f"local[{cpus}]", cpus, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    def once(name):
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    if not sys.argv[1:]:
        for name, build in STORED.items():
            start = time.perf_counter()
            build(spark, sf_dir)
            seconds[name] = round(time.perf_counter() - start, 3)
            print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    for name in chosen:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

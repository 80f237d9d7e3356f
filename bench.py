"""Headline queries at one scale; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times into the no-op
sink; its figure is the median. The no-op sink makes Spark produce every row
without collecting or storing it.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registry import all_queries  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "filter_basic", "join_inner", "join_broadcast", "join_salted", "join_range_price", "agg_group", "agg_count_distinct",
    "agg_salted", "dedup_latest", "top_k", "merge_conditional", "as_of_version", "change_feed", "cdc_scd1", "cdc_scd2",
    "quarantine", "gold_daily_revenue", "abac_apply", "usage_cost", "knn_exact", "keyword_search", "stream_tumbling_agg",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = all_queries(), {}
    for name in names:
        times = []
        for turn in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, root).write.format("noop").mode("overwrite").save()
            if turn:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    sf = root.rsplit("sf", 1)[-1]
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()

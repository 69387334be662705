"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and then three times; the median counts.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = ["frequency_count", "most_common", "top_words_per_document", "text_profile", "filtered_nearest",
            "nearest_vectors", "nearest_per_query", "keyword_score", "hybrid_rank", "newest_order_per_customer",
            "order_view", "order_with_customer", "tier_lookup", "percentile_per_key", "latency_stats",
            "moving_average", "rolling_counts", "running_average", "rank_per_group", "group_count_having",
            "multiset_difference", "merge_amounts", "upsert", "json_contains", "upload_rows", "validate_rejected",
            "limit_sliding_window", "replay_machine", "sum_of_squares", "customer_with_orders"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from tessera.operators.aggregates import sum_of_squares
    from tessera.plans import QUERIES
    from tessera.session import get_session

    spark = get_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def squares():
        """Two sums of 50 million squares, as in the published figure."""
        for _ in range(2):
            sum_of_squares(spark.range(50_000_000), "id").collect()

    def run(name):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    times = {}
    jobs = {name: (lambda n=name: run(n)) for name in HEADLINE}
    jobs["sum_of_squares_2x50m"] = squares
    for name, job in jobs.items():
        job()
        took = []
        for _ in range(runs):
            start = time.perf_counter()
            job()
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took), 4)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(folder).name}))


if __name__ == "__main__":
    main()

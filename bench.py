"""Time the headline queries: one JSON line with the median of warm runs in seconds."""

import json
import os
import statistics
import sys
import time

from vereda.session import get_session, release_parked
from vereda.plans.workload import QUERIES

HEADLINE = [
    "gold_panorama", "silver_indicators", "silver_event_points", "silver_part_points",
    "gold_ranking", "percentile_of_events", "rank_events_in_group", "series_points",
    "flatten_places", "to_messages", "ingest_counts", "ingest_series_stream", "stream_resume",
    "contamination_threshold", "zscore", "isolation_forest", "quality_summary",
]
RUNS = 2


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = get_session("bench", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": cores, "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - began
        release_parked(spark)
        return taken

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "total of headline queries, warm median", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
        "cpus": int(cores),
    }))


if __name__ == "__main__":
    main()

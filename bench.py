"""Times the headline queries and prints one JSON line.

Every query is run in full with a sink that discards its rows. One warm-up, then the median of the
timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ohmstead.plans import catalogue  # noqa: E402
from ohmstead.session import build_session  # noqa: E402

HEADLINE = [
    "daily_usage_zone", "enriched_history", "calendar_spine", "long_gaps", "cap_outliers", "local_spikes", "point_ceiling", "clean_level_site",
    "lag_features", "rolling_features", "feature_frame", "group_metrics", "global_metrics", "parity_p99", "ridge_evaluation", "markdown_blocks",
    "html_blocks", "page_cards", "bucket_pages", "evidence_blocks", "report_chunks", "section_skeleton", "greedy_distinct", "group_classes",
    "report_quality", "entity_geometry", "feature_classes", "balanced_clean", "selected_entities", "box_density", "hairline_removal",
    "small_component_removal",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session("ohmstead-bench", cores=cores)
    spark.sparkContext.setLogLevel("ERROR")
    known = catalogue.all_queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        known[name].build(spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    known["daily_usage_zone"].build(spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in wanted:
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()

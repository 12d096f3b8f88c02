"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobstrata.checks import REGISTRY  # noqa: E402
from jobstrata.session import build_session  # noqa: E402

HEADLINE = [
    "role_skill_demand", "relevance_filter_whole_texts", "skill_extraction", "location_names", "posting_dates",
    "page_cards", "page_descriptions", "json_files_to_postings", "first_seen_per_platform", "label_batches",
    "fact_keys", "fact_merge", "bridge_new_rows", "dimension_new_members", "nearest_place", "star_skill_demand",
    "monthly_volume", "near_duplicates_dropped", "near_duplicate_texts_dropped", "loaded_postings",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(2 * int(cpus)), "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()  # start the engine
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()

"""Seconds per headline query on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from campusloom.session import local_session
from registry import QUERIES

HEADLINE = [
    "ctr_priorities", "url_classes", "discovered_pages", "page_texts", "merged_sources", "program_matches",
    "unmatched_demand", "country_course_edges", "reconciled_ranking", "filled_gaps", "enriched_catalog",
    "field_coverage", "crawl_health", "breaker_states", "unique_slugs", "assembled_content", "adaptive_reading",
    "processing_rate", "ranked_sections", "resolved_countries",
]


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cpus, partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    # A warm JVM: one query on the smallest data stays outside the timings.
    QUERIES["ctr_priorities"](spark, os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")).collect()
    took: dict[str, float] = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()

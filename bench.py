"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagetables.plans import catalog  # noqa: E402
from pagetables.session import local_session  # noqa: E402

HEADLINE = [
    "link_frontier", "resolve_links", "distinct_links_total", "crawl_schedule", "robots_verdict",
    "html_blocks", "html_lines", "first_text", "rule_fields", "listing_record", "dom_record",
    "flat_product", "nested_product", "reconcile_sources", "reconcile_page", "recursive_slugs",
    "default_pick", "composite_key_violations", "unique_violations", "assign_ids", "update_by_key",
    "upsert_by_key", "lookup_batch", "category_crawl", "url_table", "substring_search", "squash_whitespace", "csv_roundtrip",
    "run_ledger", "harvest_growth", "stream_harvest", "stream_upsert", "stream_run_summary",
    "card_frontier", "listing_harvest", "listing_records", "robots_rfc9309", "result_runs",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    spark = local_session(cpus, cpus, **{"spark.driver.memory": "16g"})
    builds = catalog.queries()
    times = {}
    # The first query of a session pays for its start; that is not what is timed.
    builds[HEADLINE[0]](spark, folder).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        start = time.perf_counter()
        builds[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

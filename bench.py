"""Times the headline queries and prints one JSON line.

Each query is written to the ``noop`` sink, so that every row and column is computed. The figure is the
second of two runs: the first compiles the plan's code and starts the Python workers.
"""

from __future__ import annotations

import json
import os
import time

from docloom.plans.queries import all_queries
from docloom.session import local_session

HEADLINE = (
    "page_text_arrays", "page_text_pages", "page_text_elements", "request_build", "request_variants",
    "response_status_v1", "response_status_v2", "policy_summary", "coverages", "coverages_v2", "exposures",
    "dashboard_from_output", "dashboard_view", "dashboard_rows", "coverage_detail", "usage_rollup",
    "contract_violations", "orphan_elements", "orphan_citations", "completeness", "normalized_coverages",
    "confidence_bands", "policy_term_check", "variant_compare",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("docloom-bench", cpus)
    registered = all_queries()
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    if names == ["all"]:
        names = list(registered)
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps({
            "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
            "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every query
runs once to warm up, then BENCH_RUNS times; the median is reported. A run goes from
building the DataFrame to having computed every row and column of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leadchecks.queries import ALL  # noqa: E402
from leadchecks.session import local_session  # noqa: E402

HEADLINE = (
    "page_scan",
    "text_content",
    "place_name",
    "page_links",
    "extract_phone",
    "extract_emails",
    "place_record",
    "lookup_text",
    "preferred_email",
    "lead_filter",
    "dedup_name",
    "dedup_key",
    "email_enrich",
    "merge_results",
    "search_plan_zones",
    "search_result_scan",
    "contact_summary",
    "links_per_query",
    "running_unique",
    "progress_counts",
    "leads",
    "subdivided_leads",
    "results_store",
    "stream_leads",
)


def timed(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    ALL[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("bench", cores)
    spark.conf.set("spark.sql.shuffle.partitions", cores)
    seconds = {}
    for name in HEADLINE:
        timed(spark, sf_dir, name)
        seconds[name] = round(statistics.median(timed(spark, sf_dir, name) for _ in range(runs)), 3)
    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()

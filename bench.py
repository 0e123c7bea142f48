"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.  Each query runs twice and writes all its
rows and columns to Spark's no-op sink; the better time counts.
"""

from __future__ import annotations

import json
import os
import time

from twinsync.plans import catalog
from twinsync.session import local_session

HEADLINE = (
    "sync_flagship", "unified", "crosswalk", "scd2_apply", "outbox_a", "outbox_b", "outbox_apply_results",
    "translate_payload", "latest_snapshot_a", "latest_by_composite_key", "upsert_by_key", "bronze_nested_json",
    "bronze_flat_json", "option_set_dim", "incremental_filter", "watermark_current", "redact_documents",
    "redact_text", "stream_ingest", "sync_two_runs",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, **{"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    queries = catalog.all_queries()
    spark.range(1000).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale,
    }))


if __name__ == "__main__":
    main()

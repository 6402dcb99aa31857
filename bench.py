"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_REPEATS`` the
runs of each query after one that warms up.  A query's time is the median of full runs
into a sink that discards rows; scratch tables go to one shared folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyline.plans.queries import REGISTRY  # noqa: E402
from tallyline.session import local_session  # noqa: E402

HEADLINES = [
    "envelope_decode",
    "latest_per_key",
    "latest_per_key_maxby",
    "cdc_apply",
    "merge_outer_composite_key",
    "kpi_statements",
    "kpi_full",
    "yoy_growth",
    "growth_long_groups",
    "average_all_rounded",
    "average_refresh",
    "html_statement_roundtrip",
    "statement_transpose",
    "snapshot_upsert_roundtrip",
    "stream_cdc_apply",
]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINES
    seconds = {}
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        spark = local_session("bench", cpus, shuffle_partitions=cpus, spark_checkpoint_dir=shared)
        for name in names:
            query = REGISTRY[name][0]
            run(query, spark, sf_dir)
            seconds[name] = round(statistics.median(run(query, spark, sf_dir) for _ in range(repeats)), 3)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "cores": cpus,
                "repeats": repeats,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

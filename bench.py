"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once cold, then ``BENCH_RUNS`` warm times; its figure is the
median warm wall time of building the plan and running it to a ``noop``
sink (nothing is collected to the driver).  ``rows`` tells how many rows each
gives, so that work and speed can be told apart.  The layer files and the listing
derived from the tables are written before, and timed apart.  Prints ONE JSON
line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelflow.plans import catalog, fixtures  # noqa: E402
from parcelflow.session import build_session  # noqa: E402

HEADLINE = (
    "unified_features",
    "lot_assignment",
    "export_sorted",
    "extract_commune",
    "extract_many_extents",
    "locate_by_containment",
    "manifest_resume",
    "page_links",
    "file_inventory",
    "reachable_files",
    "export_fusion",
    "crawl_files",
)


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    qs = catalog.queries()
    t0 = time.perf_counter()
    fixtures.layer_files(spark, sf_dir)
    fixtures.file_listing(spark, sf_dir)
    fixture_sec = time.perf_counter() - t0
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in (only or HEADLINE):
        fn = qs[name]
        cold[name] = round(run_once(spark, fn, sf_dir), 3)
        times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
        rows[name] = fn(spark, sf_dir).count()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "rows": rows,
        "fixture_sec": round(fixture_sec, 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "warm_runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline-query benchmark.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is forced
to completion through the ``noop`` sink (full computation, nothing collected).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dosecast.plans import catalog  # noqa: E402
from dosecast.session import build_session, release  # noqa: E402

HEADLINE = [
    "monthly_removals", "monthly_usage", "monthly_snapshot", "latest_cost", "panel", "eligible_panel",
    "training_profile", "huber_models", "ridge_models", "result_table", "final_estimates", "error_summary",
    "crossings", "segment_intersections", "snap_points", "split_h_at_points", "pixel_components",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", int(cpus) * 2)
    # warm-up: JVM, parquet footers and the Python workers
    catalog.run("scan_tx", spark, sf_dir).limit(1).collect()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        catalog.run(n, spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        release(spark)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()

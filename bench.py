"""Headline benchmark: prints one JSON line.

Runs the flagship catalog chain, the TPC-H style pricing summary and
star join, the as-of join, batch sessionization and PageRank on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``.  Each query is executed to completion with the
``noop`` sink (every row is produced, nothing is collected to the
driver); the figure is the median of 3 runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ("catalog_pipeline", "agg_group", "join_star", "asof_backward", "sessions_batch", "pagerank")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from marquee.plans import registry
    from marquee.session import build_session, checkpoint_dir

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="marquee-bench")
    checkpoint_dir(spark)
    qs = registry.queries()
    names = [n for n in HEADLINE if n in qs]
    out: dict[str, float] = {}
    for name in names:
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                times.append(dt)
        out[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": sf, "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

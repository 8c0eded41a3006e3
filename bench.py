"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect to the
driver), after a warm-up on the smallest fixture (JVM, JIT, Python workers).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from threadweave.plans.catalog import QUERIES  # noqa: E402
from threadweave.runtime import drop_scratch, local_session  # noqa: E402

HEADLINE = [
    "popular_pairs_named",
    "popular_posters_named",
    "most_common_dst",
    "pair_counts_text",
    "pagerank_users",
    "pagerank_property_graph",
    "scc_users",
    "scc_monthly",
    "scc_component_members",
    "triangle_count",
    "motif_collab_distinct",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, cpus)
    # warm-up on the smallest fixture: JVM start, JIT, Python workers (not timed)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in ("popular_pairs_named", "scc_users", "pagerank_users"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 2)
        drop_scratch(spark)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 2), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()

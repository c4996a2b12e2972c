"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line.

Each query runs to completion into Spark's no-op sink (full execution, no
driver collect). The session is warmed on the smallest table first so JVM
start-up is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "envelope_parse",          # S1/T19/T20: JSON envelopes of every document
    "adaptive_thin",           # F5: per-sender thinning without a per-sender task
    "templates",               # T1-T17 + A1: normalise, hash, dedupe (flagship)
    "dedupe_exact",            # A1 on a whitespace-folded key
    "assign",                  # V4: nearest centroid for every vector
    "neighbour_pairs",         # J9: exact tiled similarity join
    "density_clusters",        # V5: density clusters of every vector
    "group_names",             # N1: TF-IDF label per (sender, language)
    "drift_summary",           # E1: whole drift run (templates -> vectors -> profile -> assign -> discover)
]


def main() -> None:
    from herald.catalog import QUERIES, SPREAD_CONF
    from herald.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # one JVM is driver and executors here; the test tables are single splits, so inputs are dealt to all cores
    spark = build_session(f"local[{cpus}]", app="herald-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g", SPREAD_CONF: cpus})
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()

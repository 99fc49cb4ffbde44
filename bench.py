"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs its whole plan into the ``noop`` sink (no collect). One
untimed warm-up round over all queries, then $BENCH_RUNS (default 5) timed
rounds; each query's median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadpulse.plans import registry  # noqa: E402
from roadpulse.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session("roadpulse-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus),
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    registry.load_all()
    names = [n for n in registry.QUERIES if not only or n in only]
    samples: dict[str, list[float]] = {n: [] for n in names}
    # Round 0 warms the JVM (class loading, codegen, JIT) and is not timed;
    # then every round runs each query once, so warm-up is spread evenly.
    for rnd in range(runs + 1):
        for name in names:
            t0 = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if rnd:
                samples[name].append(time.perf_counter() - t0)
    timings = {n: round(statistics.median(v), 4) for n, v in samples.items()}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

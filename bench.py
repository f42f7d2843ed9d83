"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no rows are sent
to the driver): one warm-up run, then the median of ``$BENCH_RUNS`` (default
some includes writing tables, and running it; ``build`` says what of it was
building. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hearth.plans import registry  # noqa: E402
from hearth.session import build_session  # noqa: E402


def run_once(spark, name, sf_dir) -> tuple[float, float]:
    """Seconds in all, and those of building."""
    t0 = time.perf_counter()
    df = registry.build(name, spark, sf_dir)
    built = time.perf_counter() - t0
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0, built


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="hearth-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "4g"})
    reg = registry.load_all()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times, builds, failed = {}, {}, {}
    for name in reg:
        try:
            run_once(spark, name, sf_dir)  # warm-up: planning, codegen, file listing
            samples = [run_once(spark, name, sf_dir) for _ in range(runs)]
        except Exception as e:  # recorded in the output, never hidden
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        times[name] = round(statistics.median(s for s, _ in samples), 3)
        builds[name] = round(statistics.median(b for _, b in samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "build": builds, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()

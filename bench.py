"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no collect to the
driver). The driver's tables are single-row-group files, one split each; the
bench first writes them as one file per core (not measured), as a table on a
cluster has many. Before measuring, the headline queries run once on the
smallest data set (sf0.001) to warm the JVM (class loading, JIT), so the
numbers measure the queries rather than start-up. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adpulse.plans.registry import load_all  # noqa: E402
from adpulse.session import get_spark  # noqa: E402


TABLES = "region nation customer supplier part orders lineitem events".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [a for a in sys.argv[1:]]
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    registry = load_all()
    selected = names or [n for n, q in registry.items() if q.headline]

    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in selected:
            registry[name].build(spark, warm_dir).write.format("noop").mode("overwrite").save()

    sf = os.path.basename(sf_dir).replace("sf", "")
    spread = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            spark.read.parquet(path).repartition(cpus).write.parquet(f"{spread}/{table}.parquet")
    sf_dir = spread

    timings = {}
    for name in selected:
        t0 = time.perf_counter()
        df = registry[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()

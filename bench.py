"""Benchmark the headline feature builds.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full (noop sink: every row is produced, nothing is
collected) and timed.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlens.plans import registry  # noqa: E402
from marketlens.session import get_spark  # noqa: E402

HEADLINE = [
    "products_snapshot",
    "reputation_snapshot",
    "payments_snapshot",
    "customers_snapshot",
    "delivery_snapshot",
    "geo_snapshot",
    "backfill_products",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app_name="marketlens-bench", shuffle_partitions=2 * cpus,
                      extra_conf={"spark.driver.memory": "16g",
                                  # local[N]: aim for at least one shuffle partition per core
                                  "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"})
    qs = registry.queries()
    # Warm-up: JVM, parquet footers, codegen caches (not timed).
    qs["delivery_snapshot"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "feature_build_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

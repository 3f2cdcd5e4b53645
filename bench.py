"""Time every query of the catalogue and print one JSON line.

Each query runs to a noop sink, so all its rows and columns are computed and none is collected.
``queries`` holds warm times (best of two after the first run), ``cold`` the first run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillmark.plans.catalogue import all_queries  # noqa: E402
from quillmark.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    wanted = sys.argv[1:]
    spark = local_session("bench", cpus)
    spark.range(1000).selectExpr("sum(id)").collect()
    cold, warm = {}, {}
    for name, fn in all_queries().items():
        if wanted and name not in wanted:
            continue
        times = []
        for _ in range(3):
            start = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        cold[name], warm[name] = round(times[0], 3), round(min(times[1:]), 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "catalogue_warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

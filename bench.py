"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line on stdout:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

* batch queries are forced with a ``noop`` write (full execution, no collect);
* ``split_days`` writes the stand-in trips as 30 daily landing files;
* ``ingest_tick`` is one streaming tick over those files (silver, file cells,
  gold, serving, ledger), ``noop_tick`` a tick with nothing new,
  ``late_tick`` a tick with one late file per day;
* ``total_revenue_api`` / ``avg_revenue_api`` are median latencies of the
  consumer calls (budgets 1 s and 50 ms).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import timeit

from pyspark.sql import functions as F

from tidemark import api
from tidemark.plans import batch
from tidemark.session import build_session, scratch_dir
from tidemark.sinks.split import split_days
from tidemark.sources import standin
from tidemark.sources.zones import write_zones_csv

BATCH = [
    "silver_clean",
    "hour_denorm",
    "revenue_by_day_hour",
    "hourly_revenue",
    "hourly_revenue_merge",
    "avg_revenue",
    "unmatched_zone_revenue",
    "reconcile",
    "grain_cardinality",
    "month_filter",
    "ledger_latest_status",
    "total_revenue",
]


def _typical(call, calls: int) -> float:
    """The middle one of so many timed calls, after an untimed one."""
    call()
    return sorted(timeit.repeat(call, number=1, repeat=calls))[calls // 2]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=cpus)
    times: dict[str, float] = {}

    # warm the JVM once (JIT, class loading) so the first query is not penalised
    batch.hourly_revenue(spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in BATCH:
        df = batch.QUERIES[name](spark, sf_dir)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[name] = time.perf_counter() - t0

    root = scratch_dir(spark, "bench")
    landing, lake_root, zones = f"{root}/landing", f"{root}/lake", f"{root}/zones"
    write_zones_csv(standin.zones(spark, sf_dir), zones)
    trips = standin.trips(spark, sf_dir)

    t0 = time.perf_counter()
    split_days(spark, trips.where(F.hour("tpep_pickup_datetime") < 20), landing)
    times["split_days"] = time.perf_counter() - t0

    api.migrate(spark, lake_root)
    t0 = time.perf_counter()
    rep = api.run_etl(spark, landing, lake_root, zones)
    times["ingest_tick"] = time.perf_counter() - t0
    print(f"ingest batches={rep.n_batches} stages={[b['timings'] for b in rep.batches]}", file=sys.stderr)

    t0 = time.perf_counter()
    api.run_etl(spark, landing, lake_root, zones)
    times["noop_tick"] = time.perf_counter() - t0

    split_days(spark, trips.where(F.hour("tpep_pickup_datetime") >= 20), landing, name_suffix=".late")
    t0 = time.perf_counter()
    api.run_etl(spark, landing, lake_root, zones)
    times["late_tick"] = time.perf_counter() - t0

    times["total_revenue_api"] = _typical(lambda: api.total_revenue(spark, lake_root, "2024-01-10", 5), 20)
    times["avg_revenue_api"] = _typical(lambda: api.avg_revenue(spark, lake_root, 5), 50)

    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in times.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()

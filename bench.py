"""Benchmark: the six-table analytics run over the observation stream derived from ``events``.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
  BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEATS (default 3).
Per-query numbers are medians over the repeats; ``value`` is the median wall time of the
whole analytics run (six tables written, counted, plans recorded), comparable to the
reference's "analytics function duration".
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from skylens.plans.analytics import RunConfig, run_from_lake
    from skylens.plans.lake import build_lake
    from skylens.session import build_session
    from skylens.sources.events import state_rows, table
    from skylens import registry

    scratch = tempfile.mkdtemp(prefix="skylens-bench-")
    spark = build_session(f"local[{cpus}]", app="skylens-bench", shuffle_partitions=cpus,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch})
    # a stored table of several files, as a cluster reads; the given one is a single file, hence a single task
    table(spark, sf_dir, "events").repartition(cpus * 2).write.parquet(scratch + "/sf/events.parquet")
    sf_dir, sf = scratch + "/sf", os.path.basename(sf_dir).replace("sf", "")
    started = time.perf_counter()
    build_lake(spark, state_rows(table(spark, sf_dir, "events")), scratch + "/lake")
    ingest_s = time.perf_counter() - started
    bounds = spark.read.parquet(scratch + "/lake/silver").agg({"snapshot_time": "min"}).first()[0], \
        spark.read.parquet(scratch + "/lake/silver").agg({"snapshot_time": "max"}).first()[0]
    start, end = bounds[0] // 300 * 300, (bounds[1] // 300 + 1) * 300

    runs, per_table = [], {}
    for i in range(repeats):
        t0 = time.perf_counter()
        report = run_from_lake(spark, scratch + "/lake", RunConfig(output=f"{scratch}/run{i}", start=start, end=end))
        runs.append(time.perf_counter() - t0)
        for name, sec in report["seconds"].items():
            per_table.setdefault(name, []).append(sec)

    extra = {}
    for name in ("overview_windows", "density_stats", "movement_pages", "cpr_positions", "frame_decode", "state_envelopes"):
        times = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            registry.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        extra[name] = round(statistics.median(times), 3)

    queries = {name: round(statistics.median(v), 3) for name, v in per_table.items()}
    queries.update(extra)
    queries["ingest_silver_gold"] = round(ingest_s, 3)
    print(json.dumps({"metric": "analytics_run_wall_time", "value": round(statistics.median(runs), 3),
                      "unit": "sec", "queries": queries, "sf": sf,
                      "rows": report["source_observations"], "counts": report["counts"], "cpus": cpus,
                      "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()

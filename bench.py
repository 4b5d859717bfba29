#!/usr/bin/env python
"""Benchmark the named views.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3), BENCH_QUERIES (comma list, default all),
BENCH_STAGED_DIR (reuse inputs staged by an earlier run of the same scale),
BENCH_SHUFFLE_METRICS (default 1; 0 turns off the event log).

Inputs are first staged once into a new run folder under the shared folder
(``spark.checkpoint.dir``; a fresh scratch folder when unset): export-shaped
parquet tables and the export CSV text spread over several files, and the wide
reports as one text file each.  Each view is counted once (warm-up, output
rows), then runs ``BENCH_REPEATS`` times into Spark's ``noop`` sink (full
execution, nothing collected); the median is reported.  The last run of each
view is tagged, and its shuffle write/read bytes are read from Spark's event log
in a scratch folder.  Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll import catalog  # noqa: E402
from tillroll.session import build_session, run_folder  # noqa: E402


def _run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def shuffle_bytes_by_group(log_dir: str) -> dict[str, dict[str, int]]:
    """Shuffle write/read bytes per job group, from Spark's event log."""
    stage_group, totals = {}, {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and not os.path.basename(p).startswith(".")
             and "appstatus" not in os.path.basename(p)]
    for path in sorted(paths):
        with open(path) as f:
            for raw in f:
                ev = json.loads(raw)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group or not m:
                        continue
                    t = totals.setdefault(group, {"shuffle_write": 0, "shuffle_read": 0})
                    t["shuffle_write"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
                    r = m.get("Shuffle Read Metrics", {})
                    t["shuffle_read"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
    return totals


def main() -> None:
    wall0 = time.perf_counter()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g")}
    log_dir = None
    if os.environ.get("BENCH_SHUFFLE_METRICS", "1") != "0":
        log_dir = tempfile.mkdtemp(prefix="tillroll-bench-events-")
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
                     "spark.eventLog.rolling.enabled": "false", "spark.eventLog.dir": log_dir})
    spark = build_session(f"local[{cpus}]", app_name="tillroll-bench",
                          shuffle_partitions=2 * cpus, conf=conf)
    t0 = time.perf_counter()
    reuse = os.environ.get("BENCH_STAGED_DIR")
    if reuse:
        staged = catalog.StagedInputs(spark, reuse)
    else:
        root = run_folder(spark, "tillroll-bench", allow_local_default=True)
        staged = catalog.StagedInputs.stage(catalog.TestDataInputs(spark, sf_dir), f"{root}/inputs")
    stage_seconds = time.perf_counter() - t0

    spark_version = spark.version
    # JVM warm-up (class loading, code generation paths) before any timing.
    for name in ("bought_together", "product_week_revenue", "customer_profile"):
        _run(catalog.VIEWS[name](staged))

    timings, rows = {}, {}
    for name, view in catalog.VIEWS.items():
        if wanted and name not in wanted:
            continue
        df = view(staged)
        rows[name] = df.count()  # also the warm-up
        runs = [_run(df) for _ in range(max(repeats - 1, 0))]
        if log_dir:
            # The last timed run is tagged; its shuffle volume is read from the event log.
            spark.sparkContext.setJobGroup(f"bench:{name}", name)
        runs.append(_run(df))
        if log_dir:
            spark.sparkContext.setJobGroup("", "")
        timings[name] = round(statistics.median(runs), 4)

    spark.stop()
    shuffles = {g.split(":", 1)[1]: v for g, v in
                (shuffle_bytes_by_group(log_dir) if log_dir else {}).items() if g.startswith("bench:")}
    print(json.dumps({
        "metric": "sum_of_median_view_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "shuffle_bytes": {k: shuffles.get(k, {"shuffle_write": 0, "shuffle_read": 0}) for k in timings},
        "stage_inputs_sec": round(stage_seconds, 3),
        "bench_wall_sec": round(time.perf_counter() - wall0, 1),
        "sf": float(os.path.basename(sf_dir).replace("sf", "") or 0),
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark_version,
    }))


if __name__ == "__main__":
    main()

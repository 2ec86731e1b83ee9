"""Developer tool: run the pipeline on a deliberately skewed input.

Raw ad rows come from ``lineitem``; then one row in three is given the same
(ad_id, reporting_start) key — a hot duplicate key holding a third of all
rows — and the same campaign. The five stages run with Spark's event log in
a fresh scratch folder; afterwards every stage is listed with its task count,
its largest task and its median task (run time and records read), so a stage
that funnels the hot key into one task stands out.

Usage: python tools_skew.py [sf_dir] [cpus]
"""

from __future__ import annotations

import glob
import json
import statistics
import sys
import tempfile
import time

import zstandard

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from adlens.plans.pipeline import run_pipeline  # noqa: E402
from adlens.session import build_session  # noqa: E402
from adlens.sources.testdata import ad_rows_from_lineitem  # noqa: E402


def skewed(raw):
    hot = F.xxhash64(F.col("_seq")) % 3 == 0
    return (raw.withColumn("ad_id", F.when(hot, F.lit("777")).otherwise(F.col("ad_id")))
            .withColumn("reporting_start",
                        F.when(hot, F.lit("01/01/1998")).otherwise(F.col("reporting_start")))
            .withColumn("reporting_end",
                        F.when(hot, F.lit("01/01/1998")).otherwise(F.col("reporting_end")))
            .withColumn("campaign_id", F.when(hot, F.lit("916")).otherwise(F.col("campaign_id"))))


def stage_report(log_dir: str) -> list[dict]:
    path = glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/events_*")
    data = zstandard.ZstdDecompressor().stream_reader(open(path[0], "rb")).read().decode()
    tasks: dict[int, list[tuple[int, int]]] = {}
    names: dict[int, str] = {}
    for line in data.splitlines():
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                    + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
            tasks.setdefault(e["Stage ID"], []).append((m.get("Executor Run Time", 0), recs))
        elif e["Event"] == "SparkListenerStageCompleted":
            names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    out = []
    for sid, ts in sorted(tasks.items()):
        runs = [t[0] for t in ts]
        recs = [t[1] for t in ts]
        out.append({"stage": sid, "tasks": len(ts), "max_ms": max(runs),
                    "median_ms": statistics.median(runs), "max_records": max(recs),
                    "total_records": sum(recs)})
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    spark = build_session(f"local[{cpus}]", 2 * cpus, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    raw = skewed(ad_rows_from_lineitem(spark, sf))
    t = time.perf_counter()
    wh, rep = run_pipeline(spark, raw)
    wall = time.perf_counter() - t
    hot = wh.read(spark, "validation_log").where("ad_id = '777'").count()
    print(json.dumps({"wall_sec": round(wall, 2), "timings": rep.timings,
                      "validation": {k: v for k, v in rep.validation.items()
                                     if k != "run_timestamp"},
                      "hot_key_rejected_rows": hot}))
    spark.stop()
    rows = stage_report(log_dir)
    total = max(r["total_records"] for r in rows) or 1
    print(f"{'stage':>5} {'tasks':>5} {'max ms':>7} {'median ms':>9} "
          f"{'max records':>11} {'share of stage':>14}")
    for r in rows:
        share = r["max_records"] / r["total_records"] if r["total_records"] else 0
        if r["total_records"] >= total * 0.05:
            print(f"{r['stage']:>5} {r['tasks']:>5} {r['max_ms']:>7} {r['median_ms']:>9.0f} "
                  f"{r['max_records']:>11} {share:>14.2f}")


if __name__ == "__main__":
    main()

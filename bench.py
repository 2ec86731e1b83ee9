"""Benchmark: the five pipeline stages and the 13 named queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Raw ad rows come from the
``lineitem`` table; every stage writes its tables to a fresh warehouse under
the shared work folder, and each query reads the written marts. A small
warm-up run at sf0.001 (not timed) loads the JVM code paths first.

In ``queries``, each ``stage_*`` entry is one pipeline step's own wall time.
Steps of one wave run as concurrent jobs, so these overlap; ``stage_total``
(and ``pipeline_sec``) is the pipeline's wall time. The ``qNN_*`` entries are
the named queries, run one after another. ``value`` is the pipeline plus the
queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlens.plans.pipeline import run_pipeline, warehouse_reports  # noqa: E402
from adlens.session import build_session  # noqa: E402
from adlens.sources.raw import SEQ, land_raw  # noqa: E402
from adlens.sources.testdata import ad_rows_from_lineitem  # noqa: E402


PUBLISHED_ROWS = 1143


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          app_name="adlens-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm) and warm != sf_dir:
        wh, _ = run_pipeline(spark, ad_rows_from_lineitem(spark, warm))
        for df in warehouse_reports(spark, wh).values():
            df.collect()

    # as many rows as the published run of the reference has, to compare with its one figure
    small = land_raw(ad_rows_from_lineitem(spark, sf_dir).orderBy(SEQ).limit(PUBLISHED_ROWS))
    t0 = time.perf_counter()
    run_pipeline(spark, small)
    small_sec = time.perf_counter() - t0

    t0 = time.perf_counter()
    wh, rep = run_pipeline(spark, land_raw(ad_rows_from_lineitem(spark, sf_dir), 2 * cpus))
    pipeline_sec = time.perf_counter() - t0
    queries = {f"stage_{k}": v for k, v in rep.timings.items()}
    q_total = 0.0
    for name, df in warehouse_reports(spark, wh).items():
        t = time.perf_counter()
        df.collect()
        dt_ = time.perf_counter() - t
        q_total += dt_
        queries[name] = round(dt_, 3)
    total = pipeline_sec + q_total
    print(json.dumps({
        "metric": "pipeline_and_queries_wall",
        "value": round(total, 3),
        "unit": "sec",
        "queries": queries,
        "pipeline_sec": round(pipeline_sec, 3),
        "queries_sec": round(q_total, 3),
        "pipeline_1143_rows_sec": round(small_sec, 3),
        "source_rows": rep.validation.get("total_rows"),
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

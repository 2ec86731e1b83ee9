"""Developer tool: physical plans of the pipeline's main operators.

Builds the warehouse at a small scale factor, then prints for each operator
its physical plan tree and, per scan, the columns read and the filters
pushed into the scan. Usage: python tools_plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from adlens.operators import anomaly, gold, ingest, reports, silver, validate  # noqa: E402
from adlens.plans.pipeline import run_pipeline  # noqa: E402
from adlens.session import build_session  # noqa: E402
from adlens.sources.testdata import ad_rows_from_lineitem  # noqa: E402


def show(name, df):
    jvm = df.sparkSession.sparkContext._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    body = text.split("== Physical Plan ==", 1)[1]
    details = body.strip("\n").partition("\n\n")[2]
    print(f"\n### {name}\n\n```")
    detailed = df._jdf.queryExecution().executedPlan().toString()
    for ln in detailed.splitlines():
        if ln.strip() and "FileScan" not in ln:
            ln = re.sub(r"\[plan_id=\d+\]", "", re.sub(r"#\d+L?", "", ln))
            print(ln[:150])
    scans = re.findall(r"\((\d+)\) Scan parquet[^\n]*\n(.*?)(?=\n\n|\Z)", details, re.S)
    for num, block in scans:
        info = dict(re.findall(r"^(\w[\w ]*): (.*)$", block, re.M))
        print(f"scan ({num}): ReadSchema={info.get('ReadSchema', '')}"
              f" PushedFilters={info.get('PushedFilters', '[]')}")
    print("```")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    raw = ad_rows_from_lineitem(spark, sf)
    wh, _ = run_pipeline(spark, raw)
    bronze = wh.read(spark, "raw_campaign_performance")
    fact = wh.read(spark, "fact_campaign_performance")
    base = wh.read(spark, "_campaign_kpis")
    kpis = wh.read(spark, "mart_campaign_kpis")
    mon = wh.read(spark, "mart_campaign_monitoring")
    show("validation: rejection reason per row (V1–V6)", validate.with_rejection_reason(raw))
    show("load: new rows after the watermark (I2–I4)",
         ingest.incremental_new_rows(raw, "2001-01-01"))
    show("fact (T3) from bronze", silver.fact_campaign_performance(bronze))
    show("dim_campaign (T1) from bronze", silver.dim_campaign(bronze))
    show("KPI mart (M7–M12) from the written campaign KPIs",
         gold.mart_from_kpis(base))
    show("daily monitoring mart (M13–M15) from the fact", gold.campaign_monitoring(fact))
    show("anomaly log (A1–A10) from the daily mart", anomaly.anomaly_log(mon))
    show("Q5 budget efficiency", reports.q05_budget_efficiency(kpis))
    show("Q6 audience by age (fact ⋈ dim_audience)",
         reports.q06_age_performance(fact, wh.read(spark, "dim_audience")))
    show("Q12 day-over-day CTR", reports.q12_ctr_change(mon))


if __name__ == "__main__":
    main()

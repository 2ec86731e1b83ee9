"""The materialized five-stage run agrees with the lazy queries; plan shape."""

import datetime as dt

import pytest

from adlens.plans.catalog import QUERIES, Pipeline
from adlens.plans.pipeline import run_pipeline, warehouse_reports
from adlens.sources.testdata import ad_rows_from_lineitem
from tests.conftest import SF001

TS = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def warehouse(spark):
    wh, rep = run_pipeline(spark, ad_rows_from_lineitem(spark, SF001), run_ts=TS)
    return wh, rep


def rows(df, drop=()):
    return sorted(tuple(r) for r in df.drop(*drop).collect())


def test_tables_equal_lazy_pipeline(spark, warehouse):
    wh, rep = warehouse
    p = Pipeline.from_testdata(spark, SF001)
    assert rows(wh.read(spark, "fact_campaign_performance")) == rows(p.fact)
    assert rows(wh.read(spark, "mart_campaign_kpis"), ["last_updated"]) == rows(p.kpis)
    assert rows(wh.read(spark, "mart_campaign_monitoring")) == rows(p.monitoring)
    assert rows(wh.read(spark, "anomaly_log"), ["detected_at"]) == rows(p.anomalies)
    assert rows(wh.read(spark, "dim_audience")) == rows(p.dim_audience)
    assert rows(wh.read(spark, "validation_summary"), ["run_timestamp"]) == rows(
        p.validation_summary)
    assert wh.read(spark, "validation_log").count() == rep.validation["rejected_rows"]
    assert wh.read(spark, "raw_campaign_performance").count() == rep.load["inserted"]


def test_reports_over_warehouse(spark, warehouse):
    wh, _ = warehouse
    reps = warehouse_reports(spark, wh)
    stamps = {"run_timestamp", "last_updated", "detected_at", "rejected_at", "loaded_at"}
    for name, df in reps.items():
        cols = sorted(set(df.columns) - stamps)
        assert cols == sorted(QUERIES[name](spark, SF001).columns), name
        assert df.count() == QUERIES[name](spark, SF001).count(), name


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_aggregation_is_partial_then_final(spark):
    plan = Pipeline.from_testdata(spark, SF001).fact._jdf.queryExecution().sparkPlan().toString()
    assert "partial_sum" in plan and "Window" not in plan


def test_validation_uses_no_window(spark):
    plan = Pipeline.from_testdata(spark, SF001).checked._jdf.queryExecution().sparkPlan().toString()
    assert "Window" not in plan


def test_scan_prunes_columns(spark, warehouse):
    from adlens.operators import silver
    wh, _ = warehouse
    df = silver.dim_campaign(wh.read(spark, "raw_campaign_performance"))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<reporting_start:date,campaign_id:string,fb_campaign_id:string>"


def test_rerun_on_same_warehouse_adds_nothing(spark, warehouse):
    wh, rep = warehouse
    before = rows(wh.read(spark, "mart_campaign_kpis"), ["last_updated"])
    bronze_before = wh.read(spark, "raw_campaign_performance").count()
    _, rep2 = run_pipeline(spark, ad_rows_from_lineitem(spark, SF001), warehouse=wh.root,
                           run_ts=TS)
    assert rep2.load["inserted"] == 0
    assert wh.read(spark, "raw_campaign_performance").count() == bronze_before
    assert rows(wh.read(spark, "mart_campaign_kpis"), ["last_updated"]) == before
    assert rep2.validation == rep.validation


def test_sql_over_registered_views(spark, warehouse):
    wh, _ = warehouse
    wh.register_views(spark)
    got = spark.sql("""
        SELECT campaign_id, total_spend,
               total_spend / SUM(total_spend) OVER () AS share, health_label
        FROM mart_campaign_kpis ORDER BY total_spend DESC""").collect()
    assert len(got) == 3 and abs(sum(r.share for r in got) - 1.0) < 1e-9
    n = spark.sql("SELECT COUNT(*) AS n FROM anomaly_log WHERE severity = 'HIGH'").first().n
    assert n == wh.read(spark, "anomaly_log").where("severity = 'HIGH'").count()


def test_dashboard_over_warehouse(spark, warehouse):
    from adlens.plans.pipeline import warehouse_dashboard
    wh, _ = warehouse
    for name, df in warehouse_dashboard(spark, wh).items():
        assert rows(df) == rows(QUERIES[name](spark, SF001)), name


def test_increments_equal_a_full_build(spark):
    """Two loads, the second from the middle of a month on, against one load of all rows."""
    import datetime as dt

    from tests.test_ingest import rows_for
    from tests.test_validate import raw_frame
    days = ["17/07/2017", "17/08/2017", "18/08/2017", "19/08/2017", "02/09/2017"]
    all_rows = raw_frame(spark, rows_for(days))
    ts = dt.datetime(2024, 1, 1)
    wh, _ = run_pipeline(spark, raw_frame(spark, rows_for(days[:3])), run_ts=ts)
    wh, rep = run_pipeline(spark, all_rows, wh.root, run_ts=ts)
    whole, full = run_pipeline(spark, all_rows, run_ts=ts)
    assert rep.load["inserted"] == 2 and full.load["inserted"] == 5
    for name in ("fact_campaign_performance", "mart_campaign_kpis", "mart_campaign_monitoring", "dim_campaign"):
        assert rows(wh.read(spark, name), ["last_updated"]) == rows(whole.read(spark, name), ["last_updated"]), name
    assert rep.checks == full.checks and rep.checks["negative_rows"] == 0

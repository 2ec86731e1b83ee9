"""Golden tests: the reference's exported marts reproduced from their inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlens.operators import anomaly, gold
from tests.golden import (
    ANOMALIES,
    KPI_SCORES,
    KPIS,
    KPIS_SCHEMA,
    MONITORING,
    MONITORING_SCHEMA,
    SUMMARY,
)


@pytest.fixture(scope="module")
def monitoring(spark):
    return spark.createDataFrame(MONITORING, MONITORING_SCHEMA).withColumn(
        "date", F.to_date("date"))


@pytest.fixture(scope="module")
def fact_from_monitoring(spark, monitoring):
    """One fact row per campaign-day carrying the day's sums."""
    return monitoring.select(
        "campaign_id", "date", F.lit("30-34_M").alias("audience_id"), "impressions",
        "clicks", F.col("spend"), F.lit(None).cast("double").alias("total_conversion"),
        "approved_conversion", F.lit(1).cast("long").alias("ad_count"))


def test_monitoring_mart_reproduces_export(fact_from_monitoring):
    got = {(r.campaign_id, r.date.isoformat()): r
           for r in gold.campaign_monitoring(fact_from_monitoring).collect()}
    assert len(got) == len(MONITORING)
    for row in MONITORING:
        r = got[(row[0], row[1])]
        assert (r.ctr_pct, r.cpa, r.cpm, r.conversion_rate_pct) == row[6:10], row[:2]
        assert (r.ctr_3day_avg, r.cpa_3day_avg) == row[10:12], row[:2]


def test_rolling_window_counts_rows_not_days(fact_from_monitoring):
    # 916 has no 08-20..08-24: 08-25's window is 08-18, 08-19, 08-25
    r = (gold.campaign_monitoring(fact_from_monitoring)
         .where((F.col("campaign_id") == "916") & (F.col("date") == "2017-08-25")).first())
    assert r.ctr_3day_avg == 0.0133
    # 08-27's CPA mean skips 08-26's missing CPA
    r = (gold.campaign_monitoring(fact_from_monitoring)
         .where((F.col("campaign_id") == "916") & (F.col("date") == "2017-08-27")).first())
    assert r.cpa_3day_avg == 2.7388


def test_campaign_totals_match_kpi_export(fact_from_monitoring):
    got = {r.campaign_id: r for r in gold.campaign_kpis(fact_from_monitoring).collect()}
    for k in KPIS:
        r = got[k[0]]
        assert (r.total_impressions, r.total_clicks, r.total_spend,
                r.total_approved_conv) == (k[1], k[2], k[3], k[5])


def test_scores_tiers_and_summary_reproduce_export(spark):
    kpis = spark.createDataFrame(KPIS, KPIS_SCHEMA)
    mart = gold.recommendations(gold.health_score(gold.health_components(kpis)))
    got = {r.campaign_id: r for r in mart.collect()}
    for cid, exp in KPI_SCORES.items():
        r = got[cid]
        assert r.score_ctr == pytest.approx(exp[0], abs=1e-12)
        assert r.score_conversion_rate == pytest.approx(exp[1], abs=1e-12)
        assert r.score_cpa == pytest.approx(exp[2], abs=1e-12)
        assert r.score_cpm == pytest.approx(exp[3], abs=1e-12)
        assert (r.health_score, r.health_label, r.performance_tier,
                r.recommendation) == exp[4:]
    summary = {r.campaign_id: r for r in gold.campaign_summary(mart).collect()}
    for cid, (top, risk) in SUMMARY.items():
        assert (summary[cid].top_strength, summary[cid].biggest_risk) == (top, risk)


def test_anomaly_log_reproduces_export(monitoring):
    got = anomaly.anomaly_log(monitoring).collect()
    rows = sorted((r.campaign_id, r.date.isoformat(), r.anomaly_type, r.severity,
                   r.metric_value, r.baseline, r.description) for r in got)
    assert rows == sorted(ANOMALIES)


def test_anomaly_sample_is_first_six_in_rule_order(monitoring):
    got = [(r.campaign_id, r.date.isoformat(), r.anomaly_type)
           for r in anomaly.anomaly_sample(monitoring).collect()]
    assert got == [(a[0], a[1], a[2]) for a in ANOMALIES]


def test_detected_at_is_stamped_when_given(monitoring):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    row = anomaly.anomaly_log(monitoring, detected_at=ts).first()
    assert row.detected_at == ts

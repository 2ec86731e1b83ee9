"""The 13 named business queries (Q1–Q13) over the marts.

Portfolio shares (Q5, Q13) divide by totals over all campaigns. The totals
are an ungrouped aggregate (one row, fixed size) broadcast back, instead of
``SUM(...) OVER ()``, which would pull every row into one task.
Audience queries (Q6, Q7) join the fact to ``dim_audience``, which has at
most 8 rows by construction, so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.config import (
    DEFAULT_RULES,
    LABEL_POOR,
    RISK_HIGH,
    RISK_LOW,
    RISK_MEDIUM,
    SEVERITY_HIGH,
    SEVERITY_MEDIUM,
    Rules,
)
from adlens.functions import money_sum, ratio, round_half_away
from adlens.functions.expr import with_scalars

R = round_half_away


def with_shares(kpis: DataFrame) -> DataFrame:
    """Each campaign's fraction of total spend and of total conversions."""
    totals = [money_sum("total_spend").alias("_all_spend"),
              F.sum("total_approved_conv").alias("_all_conv")]
    return (with_scalars(kpis, totals)
            .withColumn("_spend_frac", ratio("total_spend", "_all_spend"))
            .withColumn("_conv_frac", ratio("total_approved_conv", "_all_conv")))


def q01_kpi_overview(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "campaign_id", "total_spend", "total_clicks",
        F.col("total_approved_conv").alias("conversions"),
        R("ctr_pct", 4).alias("ctr_pct"), R("cpc", 2).alias("cpc"), R("cpa", 2).alias("cpa"),
        R("conversion_rate_pct", 4).alias("conversion_rate_pct"), R("cpm", 4).alias("cpm"),
        "health_score", "health_label",
    ).orderBy(F.col("health_score").desc_nulls_last())


def q02_top_conversions(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "campaign_id", F.col("total_approved_conv").alias("conversions"), "total_spend",
        R("cpa", 2).alias("cpa"), "health_label",
    ).orderBy(F.col("conversions").desc_nulls_last())


def q03_lowest_cpa(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "campaign_id", R("cpa", 2).alias("cpa"),
        F.col("total_approved_conv").alias("conversions"), "total_spend",
        R("conversion_rate_pct", 2).alias("conversion_rate_pct"), "health_label",
    ).orderBy(F.col("cpa").asc_nulls_last())


def q04_highest_ctr(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        "campaign_id", R("ctr_pct", 4).alias("ctr_pct"), "total_impressions",
        "total_clicks", "health_label",
    ).orderBy(F.col("ctr_pct").desc_nulls_last())


def q05_budget_efficiency(kpis: DataFrame) -> DataFrame:
    """Spend and conversion shares (%, 1 dp) and their gap as a fraction (4 dp)."""
    s = with_shares(kpis)
    return s.select(
        "campaign_id", "total_spend",
        R(F.col("_spend_frac") * 100, 1).alias("spend_share_pct"),
        "total_approved_conv",
        R(F.col("_conv_frac") * 100, 1).alias("conv_share_pct"),
        R(F.col("_conv_frac") - F.col("_spend_frac"), 4).alias("efficiency_gap"),
        R("cpa", 2).alias("cpa"), "performance_tier", "recommendation",
    ).orderBy(F.col("efficiency_gap").desc_nulls_last())


def _audience_kpis(fact: DataFrame, dim_audience: DataFrame, keys: list[str]) -> DataFrame:
    """Ratio KPIs by ``keys``; how the small dimension is joined is left to AQE."""
    spend = money_sum("spend")
    clicks, imps, appr = F.sum("clicks"), F.sum("impressions"), F.sum("approved_conversion")
    return (fact.join(dim_audience, "audience_id")
            .groupBy(*keys).agg(
                appr.alias("conversions"),
                R(spend, 2).alias("spend"),
                R(ratio(clicks, imps, 100.0), 4).alias("ctr_pct"),
                R(ratio(spend, appr), 2).alias("cpa"),
                R(ratio(appr, clicks, 100.0), 2).alias("conversion_rate_pct")))


def q06_age_performance(fact: DataFrame, dim_audience: DataFrame) -> DataFrame:
    return (_audience_kpis(fact, dim_audience, ["age_group"])
            .orderBy(F.col("conversions").desc_nulls_last()))


def q07_age_gender(fact: DataFrame, dim_audience: DataFrame) -> DataFrame:
    return (_audience_kpis(fact, dim_audience, ["age_group", "gender"])
            .orderBy(F.col("cpa").asc_nulls_last()))


def q08_daily_trend(monitoring: DataFrame) -> DataFrame:
    return monitoring.select(
        "campaign_id", "date", R("spend", 2).alias("spend"), "clicks",
        "approved_conversion", R("ctr_pct", 4).alias("ctr_pct"), R("cpa", 2).alias("cpa"),
        R("ctr_3day_avg", 4).alias("ctr_3day_avg"), R("cpa_3day_avg", 2).alias("cpa_3day_avg"),
    ).orderBy("campaign_id", "date")


def q09_health_ranking(summary: DataFrame, kpis: DataFrame) -> DataFrame:
    """Summary joined to KPIs on ``campaign_id``; AQE picks the join strategy."""
    k = kpis.select("campaign_id", "ctr_pct", "cpa", "conversion_rate_pct")
    return (summary.join(k, "campaign_id")
            .select("campaign_id", "health_score", "health_label", "performance_tier",
                    "top_strength", "biggest_risk", "recommendation", "ctr_pct", "cpa",
                    "conversion_rate_pct")
            .orderBy(F.col("health_score").desc_nulls_last()))


def severity_rank():
    sev = F.col("severity")
    return F.when(sev == SEVERITY_HIGH, 1).when(sev == SEVERITY_MEDIUM, 2).otherwise(3)


def q10_anomaly_report(log: DataFrame) -> DataFrame:
    return log.select(
        "campaign_id", "date", "anomaly_type", "severity",
        R("metric_value", 4).alias("metric_value"), R("baseline", 4).alias("baseline"),
        "description",
    ).orderBy(severity_rank(), "campaign_id", "date")


def q11_data_quality(summary: DataFrame) -> DataFrame:
    cols = ["run_timestamp", "total_rows", "valid_rows", "rejected_rows", "pct_rejected",
            "reason_invalid_campaign", "reason_null_conversion", "reason_negative_spend",
            "reason_duplicate"]
    return summary.select(*[c for c in cols if c in summary.columns])


def q12_ctr_change(monitoring: DataFrame) -> DataFrame:
    """Day-over-day CTR change per campaign: one ``lag`` over campaign × date."""
    w = Window.partitionBy("campaign_id").orderBy("date")
    prev = F.lag("ctr_pct").over(w)
    ctr = F.col("ctr_pct")
    p = F.col("prev_ctr_pct")
    return (monitoring.select("campaign_id", "date", "ctr_pct", prev.alias("prev_ctr_pct"))
            .select("campaign_id", "date", R(ctr, 4).alias("ctr_pct"), p,
                    R(ctr - p, 4).alias("ctr_change"),
                    R(ratio(ctr - p, p, 100.0), 2).alias("ctr_pct_change"))
            .orderBy("campaign_id", "date"))


def q13_concentration_risk(kpis: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    r = rules.report
    s = with_shares(kpis)
    frac = F.col("_spend_frac")
    risk = (F.when((frac > r.high_concentration) & (F.col("health_label") == LABEL_POOR),
                   F.lit(RISK_HIGH))
            .when(frac > r.medium_concentration, F.lit(RISK_MEDIUM))
            .otherwise(F.lit(RISK_LOW)))
    return s.select(
        "campaign_id", "total_spend", R(frac * 100, 1).alias("spend_share_pct"),
        "health_label", risk.alias("concentration_risk"),
    ).orderBy(F.col("total_spend").desc_nulls_last())

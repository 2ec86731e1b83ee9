"""Datasets behind the dashboard pages (D1–D16), as DataFrame functions.

Only the data is rebuilt; pages, charts and styling are not. Portfolio
totals and audience tables are bounded (one row; at most 8 audiences) and
broadcast where they are joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.config import (
    COMPONENT_LABELS,
    DEFAULT_RULES,
    REASON_DISPLAY,
    SEVERITY_HIGH,
    SEVERITY_MEDIUM,
    VERDICT_BALANCED,
    VERDICT_OVER,
    VERDICT_UNDER,
    Rules,
)
from adlens.functions import exact_mean, money_sum, ratio, round_half_away
from adlens.operators.gold import SCORE_COLUMNS
from adlens.operators.reports import with_shares

R = round_half_away


def d01_audience_kpis(fact: DataFrame, dim_audience: DataFrame) -> DataFrame:
    """KPIs per age × gender, with impressions and clicks."""
    spend = money_sum("spend")
    clicks, imps, appr = F.sum("clicks"), F.sum("impressions"), F.sum("approved_conversion")
    return (fact.join(dim_audience, "audience_id")
            .groupBy("age_group", "gender").agg(
                imps.alias("impressions"), clicks.alias("clicks"),
                R(spend, 2).alias("spend"), appr.alias("conversions"),
                R(ratio(clicks, imps, 100.0), 4).alias("ctr_pct"),
                R(ratio(spend, appr), 2).alias("cpa"),
                R(ratio(appr, clicks, 100.0), 4).alias("conversion_rate_pct"))
            .orderBy("age_group", "gender"))


def d02_blended_kpis(kpis: DataFrame) -> DataFrame:
    """Portfolio totals, blended CTR, and CPA (0 when no conversions)."""
    spend, conv = F.col("total_spend"), F.col("total_conv")
    return kpis.agg(
        money_sum("total_spend").alias("total_spend"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_approved_conv").alias("total_conv"),
        ratio(F.sum("total_clicks"), F.sum("total_impressions"), 100.0).alias("blended_ctr"),
    ).withColumn("blended_cpa", F.when(conv > 0, spend / conv).otherwise(F.lit(0.0)))


def d03_score_components_long(kpis: DataFrame) -> DataFrame:
    """D3: the four score components, one row per campaign × component, 1 dp."""
    rounded = kpis.select("campaign_id", *[R(c, 1).alias(label) for c, label in
                                           zip(SCORE_COLUMNS, COMPONENT_LABELS)])
    return rounded.unpivot("campaign_id", list(COMPONENT_LABELS), "component", "score")


def audience_label():
    """``age / gender``."""
    return F.concat(F.col("age_group"), F.lit(" / "), F.col("gender"))


def d04_audience_labels(audience: DataFrame) -> DataFrame:
    """The audience table with its ``age / gender`` label."""
    return audience.withColumn("audience", audience_label())


def d05_best_audiences(audience: DataFrame) -> DataFrame:
    """Best audience by lowest CPA and highest CTR, conversion rate, conversions.

    Audiences are ranked in (age, gender) order for ties; a missing metric
    never wins. ``min_by`` over a struct key does this in one aggregate.
    """
    def best(metric: str, lowest: bool):
        m = F.col(metric)
        key = F.struct((m if lowest else -m).alias("m"), F.col("age_group"), F.col("gender"))
        pick = F.min_by(F.struct(audience_label().alias("audience"), m.cast("double").alias("value")),
                        F.when(m.isNotNull(), key))
        return pick.alias(metric)

    specs = [("lowest_cpa", "cpa", True), ("highest_ctr", "ctr_pct", False),
             ("best_conversion_rate", "conversion_rate_pct", False),
             ("most_conversions", "conversions", False)]
    picked = audience.agg(*[best(m, low) for _, m, low in specs])
    rows = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(m).alias("p"))
                     for name, m, _ in specs])
    return (picked.select(F.explode(rows).alias("r"))
            .select("r.metric", F.col("r.p.audience").alias("audience"),
                    F.col("r.p.value").alias("value")))


def d06_age_rollup(audience: DataFrame) -> DataFrame:
    """Per age group — summed conversions and spend, unweighted mean of CPAs."""
    return (audience.groupBy("age_group").agg(
        F.sum("conversions").alias("conversions"),
        money_sum("spend").alias("spend"),
        exact_mean("cpa").alias("cpa"))
        .orderBy(F.col("conversions").desc_nulls_last()))


def d07_gender_rollup(audience: DataFrame) -> DataFrame:
    """Per gender — sums, mean CTR and mean CPA, melted to (kpi, value)."""
    g = audience.groupBy("gender").agg(
        money_sum("spend").alias("spend"),
        F.sum("conversions").alias("conversions"),
        exact_mean("ctr_pct").alias("ctr"),
        exact_mean("cpa").alias("cpa"))
    return g.unpivot(["gender", "spend", "conversions"], ["ctr", "cpa"], "kpi", "value")


def d08_ctr_pivot(audience: DataFrame) -> DataFrame:
    """CTR by age group (rows) × gender (columns F, M); missing → 0."""
    return (audience.groupBy("age_group").pivot("gender", ["F", "M"])
            .agg(F.first("ctr_pct")).fillna(0.0, subset=["F", "M"])
            .orderBy("age_group"))


def d09_efficiency_quadrant(kpis: DataFrame) -> DataFrame:
    """Spend and conversion shares in %, efficiency in points."""
    s = with_shares(kpis)
    return s.select(
        "campaign_id", "total_spend", "total_approved_conv",
        (F.col("_spend_frac") * 100).alias("spend_share"),
        (F.col("_conv_frac") * 100).alias("conv_share"),
        (F.col("_conv_frac") * 100 - F.col("_spend_frac") * 100).alias("efficiency"),
        "cpa")


def d10_budget_verdict(kpis: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Over-performing above +5 points, under-performing below −5."""
    p = rules.report.verdict_points
    eff = F.col("efficiency")
    verdict = (F.when(eff > p, F.lit(VERDICT_OVER)).when(eff < -p, F.lit(VERDICT_UNDER))
               .otherwise(F.lit(VERDICT_BALANCED)))
    return d09_efficiency_quadrant(kpis).withColumn("efficiency_flag", verdict)


def d11_rejection_reasons(summary: DataFrame) -> DataFrame:
    """Rejection counts wide → long; reasons with no rows are dropped."""
    stacked = F.array(*[F.struct(F.lit(label).alias("reason"),
                                 F.col(col).cast("long").alias("count"))
                        for label, col in REASON_DISPLAY])
    return (summary.select(F.explode(stacked).alias("r")).select("r.*")
            .where(F.col("count") > 0))


def d12_severity_totals(log: DataFrame) -> DataFrame:
    """Total anomalies and those of high and medium severity."""
    sev = F.col("severity")
    return log.agg(F.count(F.lit(1)).alias("total_anomalies"),
                   F.count_if(sev == SEVERITY_HIGH).alias("high_severity"),
                   F.count_if(sev == SEVERITY_MEDIUM).alias("medium_severity"))


def d14_rankings(kpis: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Campaigns by health score ascending and by CPA descending."""
    return d14_health_ascending(kpis), d14_cpa_descending(kpis)


def d14_health_ascending(kpis: DataFrame) -> DataFrame:
    return kpis.select("campaign_id", "health_score", "health_label").orderBy(
        F.col("health_score").asc_nulls_last())


def d14_cpa_descending(kpis: DataFrame) -> DataFrame:
    return kpis.select("campaign_id", "cpa", "health_label").orderBy(
        F.col("cpa").desc_nulls_last())


def d16_series(monitoring: DataFrame) -> DataFrame:
    """Daily CTR, CPA and spend series per campaign."""
    return monitoring.select("campaign_id", "date", "ctr_pct", "cpa", "spend").orderBy(
        "campaign_id", "date")

"""Gold layer (M1–M18): campaign KPIs, relative health score, tiers,
daily monitoring with rolling baselines, campaign summary.

Relative statistics (min/max of each KPI, medians) are global aggregates
over the one-row-per-campaign KPI table. They are computed as an ungrouped
aggregate — one row, so its size is fixed — and broadcast-joined back; no
``Window`` without ``partitionBy`` (which would move every row into one
task) is used anywhere.

The daily monitoring mart aggregates the fact per campaign × date (partial
aggregation first) and then runs its rolling windows partitioned by
campaign: after the daily aggregation a campaign holds one row per day, so
even a campaign with a third of all ad rows is a few thousand rows there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.config import (
    COMPONENTS,
    DEFAULT_RULES,
    LABEL_AVERAGE,
    LABEL_EXCELLENT,
    LABEL_GOOD,
    LABEL_POOR,
    REC_OPTIMIZE,
    REC_REDUCE,
    REC_REVIEW,
    REC_SCALE,
    TIER_HIGH,
    TIER_POOR,
    TIER_STANDARD,
    Rules,
)
from adlens.functions import money_sum, ratio, round_half_away
from adlens.functions.expr import attach_row, merged_money, with_scalars
from adlens.functions.stats import exact_medians, sketched_medians

KPI_COLUMNS = [
    "campaign_id", "total_impressions", "total_clicks", "total_spend",
    "total_conversions", "total_approved_conv", "fact_rows", "ctr_pct", "cpc",
    "cpa", "conversion_rate_pct", "cpm",
]
SCORE_COLUMNS = ["score_ctr", "score_conversion_rate", "score_cpa", "score_cpm"]
MART_KPI_COLUMNS = KPI_COLUMNS + SCORE_COLUMNS + [
    "health_score", "health_label", "performance_tier", "recommendation"]
MONITORING_COLUMNS = [
    "campaign_id", "date", "impressions", "clicks", "spend", "approved_conversion",
    "ctr_pct", "cpa", "cpm", "conversion_rate_pct", "ctr_3day_avg", "cpa_3day_avg",
]
SUMMARY_COLUMNS = ["campaign_id", "health_score", "health_label", "performance_tier",
                   "recommendation", "top_strength", "biggest_risk"]


# -- M1–M6: campaign KPIs ---------------------------------------------------------

def _kpis(grouped, imps: Column, clicks: Column, spend: Column, conversions: Column, appr: Column, rows: Column) -> DataFrame:
    return grouped.agg(
        imps.cast("double").alias("total_impressions"),
        clicks.cast("double").alias("total_clicks"),
        round_half_away(spend, 2).alias("total_spend"),
        conversions.cast("double").alias("total_conversions"),
        appr.cast("double").alias("total_approved_conv"),
        rows.alias("fact_rows"),
        round_half_away(ratio(clicks, imps, 100.0), 4).alias("ctr_pct"),
        round_half_away(ratio(spend, clicks), 4).alias("cpc"),
        round_half_away(ratio(spend, appr), 4).alias("cpa"),
        round_half_away(ratio(appr, clicks, 100.0), 4).alias("conversion_rate_pct"),
        round_half_away(ratio(spend, imps, 1000.0), 4).alias("cpm"),
    )


def campaign_kpis(fact: DataFrame) -> DataFrame:
    """M1–M6: totals and ratio KPIs per campaign, each ratio of sums, 4 dp."""
    return _kpis(fact.groupBy("campaign_id"), F.sum("impressions"), F.sum("clicks"), money_sum("spend"),
                 F.sum("total_conversion"), F.sum("approved_conversion"), F.count(F.lit(1)))


def kpis_from_totals(totals: DataFrame) -> DataFrame:
    """M1–M6 from the months' totals (``silver.fact_totals``)."""
    return _kpis(totals.groupBy("campaign_id"), F.sum("impressions"), F.sum("clicks"), merged_money("spend"),
                 F.sum("total_conversion"), F.sum("approved_conversion"), F.sum("fact_rows"))


# -- M7–M9: relative health score -------------------------------------------------

def health_components(kpis: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """M7: min-max score 0–25 per KPI over all campaigns (CPA, CPM inverted).

    Every row scores ``all_equal_score`` when a KPI's min equals its max; a
    missing KPI stays missing otherwise.
    """
    r = rules.score
    specs = [("ctr_pct", "score_ctr", False),
             ("conversion_rate_pct", "score_conversion_rate", False),
             ("cpa", "score_cpa", True),
             ("cpm", "score_cpm", True)]
    joined = with_scalars(kpis, [a for k, _, _ in specs for a in (
        F.min(k).alias(f"_lo_{k}"), F.max(k).alias(f"_hi_{k}"))])
    scores = []
    for k, name, invert in specs:
        lo, hi = F.col(f"_lo_{k}"), F.col(f"_hi_{k}")
        norm = (F.col(k) - lo) / (hi - lo) * F.lit(r.component_max)
        if invert:
            norm = F.lit(r.component_max) - norm
        scores.append(F.when(hi == lo, F.lit(r.all_equal_score)).otherwise(norm).alias(name))
    return joined.select(*kpis.columns, *scores)


def health_label(score: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """M9: Excellent ≥ 90, Good ≥ 70, Average ≥ 50, else (and missing) Poor."""
    r = rules.score
    return (F.when(score >= r.excellent, F.lit(LABEL_EXCELLENT))
            .when(score >= r.good, F.lit(LABEL_GOOD))
            .when(score >= r.average, F.lit(LABEL_AVERAGE))
            .otherwise(F.lit(LABEL_POOR)))


def health_score(components: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """M8–M9: sum of the four components (2 dp) and its label."""
    total = sum((F.col(c) for c in SCORE_COLUMNS[1:]), F.col(SCORE_COLUMNS[0]))
    return (components.withColumn("health_score", round_half_away(total, 2))
            .withColumn("health_label", health_label(F.col("health_score"), rules)))


# -- M10–M11: medians, tiers, recommendations ---------------------------------------

MEDIANS = {"cpa": "median_cpa", "conversion_rate_pct": "median_cr", "total_spend": "median_spend"}


def kpi_medians(kpis: DataFrame, approximate: bool = False) -> DataFrame:
    """Medians of CPA, conversion rate and spend (one row), exact unless asked otherwise.

    Missing values are skipped; an even count averages the two middle
    values. The values are ranked by a distributed sort of their counts
    (``functions.stats``) and never gathered. ``approximate`` takes them from KLL
    sketches, which need one pass and no sort.
    """
    return sketched_medians(kpis, MEDIANS) if approximate else exact_medians(kpis, MEDIANS)


def recommendations(scored: DataFrame, rules: Rules = DEFAULT_RULES, approximate: bool = False) -> DataFrame:
    """Tier and recommendation, four ordered cases.

    A comparison that meets a missing value is false, so such a row falls
    through to the next case.
    """
    r = rules.score
    med = kpi_medians(scored, approximate)  # exactly one row
    s, cpa, cr, spend = (F.col("health_score"), F.col("cpa"),
                         F.col("conversion_rate_pct"), F.col("total_spend"))
    high = (s >= r.high_performer_score) & (cpa <= F.col("median_cpa"))
    waste = (spend >= F.col("median_spend")) & (cr < F.col("median_cr"))
    costly = cpa > F.col("median_cpa") * F.lit(r.cpa_too_high_factor)

    def chain(a, b, c, d):
        return F.when(high, F.lit(a)).when(waste, F.lit(b)).when(costly, F.lit(c)).otherwise(F.lit(d))

    return (attach_row(scored, med)
            .withColumn("performance_tier", chain(TIER_HIGH, TIER_POOR, TIER_POOR, TIER_STANDARD))
            .withColumn("recommendation", chain(REC_SCALE, REC_REVIEW, REC_REDUCE, REC_OPTIMIZE))
            .drop("median_cpa", "median_cr", "median_spend"))


def mart_campaign_kpis(fact: DataFrame, rules: Rules = DEFAULT_RULES,
                       last_updated=None) -> DataFrame:
    """The 21-column KPI mart (``last_updated`` only when given)."""
    return mart_from_kpis(campaign_kpis(fact), rules, last_updated)


def mart_from_kpis(kpis: DataFrame, rules: Rules = DEFAULT_RULES, last_updated=None,
                   approximate: bool = False) -> DataFrame:
    """M7–M12 on a campaign KPI table (M1–M6)."""
    scored = health_score(health_components(kpis, rules), rules)
    out = recommendations(scored, rules, approximate)
    cols = [F.col(c) for c in MART_KPI_COLUMNS]
    if last_updated is not None:
        cols.append(F.lit(last_updated).cast("timestamp").alias("last_updated"))
    return out.select(*cols)


# -- M13–M15: daily monitoring --------------------------------------------------

RAW_RATIOS = ["_ctr_raw", "_cpa_raw"]


def daily_rows(fact: DataFrame) -> DataFrame:
    """Daily metrics per campaign, and the unrounded ratios that rolling means average."""
    spend = money_sum("spend")
    clicks, imps, appr = F.sum("clicks"), F.sum("impressions"), F.sum("approved_conversion")
    return fact.groupBy("campaign_id", "date").agg(
        imps.cast("double").alias("impressions"),
        clicks.alias("clicks"),
        round_half_away(spend, 2).alias("spend"),
        appr.alias("approved_conversion"),
        round_half_away(ratio(clicks, imps, 100.0), 4).alias("ctr_pct"),
        round_half_away(ratio(spend, appr), 4).alias("cpa"),
        round_half_away(ratio(spend, imps, 1000.0), 4).alias("cpm"),
        round_half_away(ratio(appr, clicks, 100.0), 4).alias("conversion_rate_pct"),
        ratio(clicks, imps, 100.0).alias("_ctr_raw"),
        ratio(spend, appr).alias("_cpa_raw"),
    )


def rolling(daily: DataFrame, rules: Rules = DEFAULT_RULES, before: DataFrame | None = None) -> DataFrame:
    """``daily`` with its rolling means, the unrounded ratios last.

    ``before`` holds each campaign's last rows ahead of ``daily`` (``last_rows``); they
    are averaged with the first ones and are not in the result.
    """
    n = rules.anomaly.rolling_rows
    new = daily.withColumn("_new", F.lit(True))
    if before is not None:
        new = new.unionByName(before.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy("campaign_id").orderBy("date").rowsBetween(-(n - 1), 0)
    return new.select(
        *MONITORING_COLUMNS[:-2],
        round_half_away(F.avg("_ctr_raw").over(w), 4).alias("ctr_3day_avg"),
        round_half_away(F.avg("_cpa_raw").over(w), 4).alias("cpa_3day_avg"),
        *RAW_RATIOS, "_new",
    ).where("_new").drop("_new")


def last_rows(daily: DataFrame, before: DataFrame | None, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Each campaign's last rows: as many as a rolling mean looks back."""
    some = daily.select("campaign_id", "date", *RAW_RATIOS)
    some = some if before is None else some.unionByName(before)
    last = Window.partitionBy("campaign_id").orderBy(F.desc("date"))
    return (some.withColumn("_back", F.row_number().over(last))
            .where(F.col("_back") < rules.anomaly.rolling_rows).drop("_back"))


def campaign_monitoring(fact: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Daily metrics per campaign with 3-row rolling CTR and CPA.

    The rolling means average the unrounded daily ratios over the current
    and two preceding rows (rows, not calendar days); AVG skips missing days.
    """
    return rolling(daily_rows(fact), rules).select(*MONITORING_COLUMNS)


# -- M16–M18: campaign summary ------------------------------------------------------

def _first_match(value: Column, labels: list[tuple[str, str]]) -> Column:
    """Name of the first component whose score equals ``value``.

    When the first component's score is missing, it wins (as an argmax that
    starts from the first entry and only moves on a strictly larger value).
    """
    first_col = labels[0][0]
    expr = F.when(F.col(first_col).isNull(), F.lit(labels[0][1]))
    for col, text in labels:
        expr = expr.when(F.col(col) == value, F.lit(text))
    return expr


def campaign_summary(kpi_mart: DataFrame) -> DataFrame:
    """Strongest component and the risk text of the weakest one."""
    cols = [F.col(c) for c, _, _ in COMPONENTS]
    top = _first_match(F.greatest(*cols), [(c, name) for c, name, _ in COMPONENTS])
    risk = _first_match(F.least(*cols), [(c, text) for c, _, text in COMPONENTS])
    return kpi_mart.select(*SUMMARY_COLUMNS[:5], top.alias("top_strength"),
                           risk.alias("biggest_risk"))

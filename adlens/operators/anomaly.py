"""Rule-based anomaly detection on the daily monitoring mart.

Four rules are checked on every (campaign, day) row in one pass: each yields
a struct or NULL, the non-NULL ones are kept in rule order and exploded — a
row may raise several flags and no 4-way union is needed.

A1's campaign mean daily spend is an unordered window partitioned by
campaign. The monitoring mart was built by a window with the same
partitioning, so when both run in one plan no extra shuffle is added; a
partition holds one row per day of a campaign.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.config import (
    ANOMALY_CPA_SPIKE,
    ANOMALY_CTR_DROP,
    ANOMALY_SPEND_SPIKE,
    ANOMALY_ZERO_CONVERSIONS,
    DEFAULT_RULES,
    SEVERITY_HIGH,
    SEVERITY_MEDIUM,
    Rules,
)
from adlens.functions import fixed, money_sum, round_half_away

ANOMALY_COLUMNS = ["campaign_id", "date", "anomaly_type", "severity",
                   "metric_value", "baseline", "description"]


def with_avg_daily_spend(monitoring: DataFrame) -> DataFrame:
    """A1: each day's row with its campaign's mean daily (rounded) spend.

    The mean is the exact sum of the 2-dp spends divided by the day count,
    so it does not depend on the order in which rows are added.
    """
    w = Window.partitionBy("campaign_id")
    total = money_sum("spend", w)
    return monitoring.withColumn("avg_daily_spend", total / F.count("spend").over(w))


def _flag(cond: Column, kind: str, severity: str, metric: Column,
          baseline: Column, description: Column, order: int) -> Column:
    return F.when(cond, F.struct(
        F.lit(order).alias("rule_order"),
        F.lit(kind).alias("anomaly_type"),
        F.lit(severity).alias("severity"),
        metric.cast("double").alias("metric_value"),
        baseline.cast("double").alias("baseline"),
        description.alias("description"),
    ))


def ctr_drop(rules: Rules = DEFAULT_RULES) -> Column:
    """A2: CTR below ``ctr_drop_factor`` × its rolling mean (mean > 0)."""
    ctr, base = F.col("ctr_pct"), F.col("ctr_3day_avg")
    cond = base.isNotNull() & (base > 0) & (ctr < base * F.lit(rules.anomaly.ctr_drop_factor))
    drop = (F.lit(1.0) - ctr / base) * 100
    text = F.concat(F.lit("CTR dropped "), fixed(drop, 1),
                    F.lit("% below 3-day average ("), fixed(ctr, 4),
                    F.lit("% vs baseline "), fixed(base, 4), F.lit("%)"))
    return _flag(cond, ANOMALY_CTR_DROP, SEVERITY_HIGH, round_half_away(ctr, 4),
                 round_half_away(base, 4), text, 1)


def cpa_spike(rules: Rules = DEFAULT_RULES) -> Column:
    """A3: CPA above ``cpa_spike_factor`` × its rolling mean (mean > 0)."""
    cpa, base = F.col("cpa"), F.col("cpa_3day_avg")
    cond = (base.isNotNull() & (base > 0) & cpa.isNotNull()
            & (cpa > base * F.lit(rules.anomaly.cpa_spike_factor)))
    spike = (cpa / base - 1) * 100
    text = F.concat(F.lit("CPA spiked "), fixed(spike, 1),
                    F.lit("% above 3-day average ($"), fixed(cpa, 2),
                    F.lit(" vs baseline $"), fixed(base, 2), F.lit(")"))
    return _flag(cond, ANOMALY_CPA_SPIKE, SEVERITY_HIGH, round_half_away(cpa, 4),
                 round_half_away(base, 4), text, 2)


def spend_spike(rules: Rules = DEFAULT_RULES) -> Column:
    """A4: daily spend above ``spend_spike_factor`` × the campaign's mean."""
    spend, avg = F.col("spend"), F.col("avg_daily_spend")
    cond = (avg > 0) & (spend > avg * F.lit(rules.anomaly.spend_spike_factor))
    text = F.concat(F.lit("Daily spend $"), fixed(spend, 2), F.lit(" is "),
                    fixed(spend / avg, 1), F.lit("x the campaign average ($"),
                    fixed(avg, 2), F.lit("/day)"))
    return _flag(cond, ANOMALY_SPEND_SPIKE, SEVERITY_MEDIUM, round_half_away(spend, 2),
                 round_half_away(avg, 2), text, 3)


def zero_conversions() -> Column:
    """A5: no approved conversion on a day with spend."""
    spend = F.col("spend")
    cond = (F.col("approved_conversion") == 0) & (spend > 0)
    text = F.concat(F.lit("Zero approved conversions despite $"), fixed(spend, 2),
                    F.lit(" spend"))
    return _flag(cond, ANOMALY_ZERO_CONVERSIONS, SEVERITY_HIGH, F.lit(0.0),
                 F.lit(None), text, 4)


def flagged(monitoring: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per raised flag, with ``rule_order`` (1–4)."""
    flags = F.array(ctr_drop(rules), cpa_spike(rules), spend_spike(rules), zero_conversions())
    return (with_avg_daily_spend(monitoring)
            .select("campaign_id", "date",
                    F.explode(F.filter(flags, lambda f: f.isNotNull())).alias("f"))
            .select("campaign_id", "date", "f.*"))


def anomaly_log(monitoring: DataFrame, rules: Rules = DEFAULT_RULES,
                detected_at=None) -> DataFrame:
    """The anomaly log (``detected_at`` only when given)."""
    cols = [F.col(c) for c in ANOMALY_COLUMNS]
    if detected_at is not None:
        cols.insert(2, F.lit(detected_at).cast("timestamp").alias("detected_at"))
    return flagged(monitoring, rules).select(*cols)


def by_rule(monitoring: DataFrame, kind: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The rows raised by one rule (A2–A5 on their own)."""
    return anomaly_log(monitoring, rules).where(F.col("anomaly_type") == kind)


def anomaly_counts(log: DataFrame) -> DataFrame:
    """Anomalies per type × severity."""
    return (log.groupBy("anomaly_type", "severity").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("anomaly_type", "severity"))


def anomaly_sample(monitoring: DataFrame, n: int = 6, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The first ``n`` anomalies by campaign, date and rule order (top-k)."""
    return (flagged(monitoring, rules)
            .orderBy("campaign_id", "date", "rule_order").limit(n)
            .select(*ANOMALY_COLUMNS))

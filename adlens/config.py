"""Domain constants, rule thresholds and fixed texts.

Everything under "Fixed values" must equal the reference's values for the
results to agree; everything else is a tunable parameter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------

VALID_CAMPAIGN_IDS = ("916", "936", "1178")
AGE_GROUPS = ("30-34", "35-39", "40-44", "45-49")
GENDERS = ("M", "F")

# rejection reasons, in rule order (the first failing rule wins)
REASON_INVALID_CAMPAIGN = "invalid_campaign_id"
REASON_NULL_CONVERSION = "null_conversion"
REASON_NEGATIVE_SPEND = "negative_spend"
REASON_DUPLICATE = "duplicate_ad_id"

# tokens a CSV reader treats as a missing value (public CSV-reader default list)
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# raw source columns, in file order
RAW_COLUMNS = (
    "ad_id", "reporting_start", "reporting_end", "campaign_id", "fb_campaign_id",
    "age", "gender", "interest1", "interest2", "interest3",
    "impressions", "clicks", "spent", "total_conversion", "approved_conversion",
)

# health labels, highest first
LABEL_EXCELLENT = "Excellent"
LABEL_GOOD = "Good"
LABEL_AVERAGE = "Average"
LABEL_POOR = "Poor"

# performance tiers and recommendations, in decision order
TIER_HIGH = "High Performer"
TIER_POOR = "Poor Performer"
TIER_STANDARD = "Standard Performer"
REC_SCALE = "Scale Budget - Strong efficiency and conversion rate"
REC_REVIEW = "Review / Pause - High spend with low conversion rate"
REC_REDUCE = "Reduce Budget - CPA is too high relative to other campaigns"
REC_OPTIMIZE = "Optimize - Test new audiences or ad creatives to improve CPA"

# score components: (score column, strength name, risk text), in tie order
COMPONENTS = (
    ("score_ctr", "CTR",
     "Low click-through rate — ad relevance may be weak"),
    ("score_conversion_rate", "Conversion Rate",
     "Low conversion rate — clicks not converting to customers"),
    ("score_cpa", "CPA Efficiency",
     "High cost per acquisition — budget not working efficiently"),
    ("score_cpm", "CPM Efficiency",
     "High cost per thousand impressions — expensive reach"),
)
# dashboard display labels of the score components, same order
COMPONENT_LABELS = ("CTR Score", "Conv Rate Score", "CPA Score", "CPM Score")

# anomaly types and severities, in rule order
ANOMALY_CTR_DROP = "CTR_DROP"
ANOMALY_CPA_SPIKE = "CPA_SPIKE"
ANOMALY_SPEND_SPIKE = "SPEND_SPIKE"
ANOMALY_ZERO_CONVERSIONS = "ZERO_CONVERSIONS"
SEVERITY_HIGH = "HIGH"
SEVERITY_MEDIUM = "MEDIUM"

# concentration-risk texts
RISK_HIGH = "HIGH RISK -- dominant spend + poor health"
RISK_MEDIUM = "MEDIUM RISK -- high spend concentration"
RISK_LOW = "LOW RISK"

# budget verdicts
VERDICT_OVER = "Over-performing"
VERDICT_UNDER = "Under-performing"
VERDICT_BALANCED = "Balanced"

# rejection reasons as shown on the data-quality page, with their summary column
REASON_DISPLAY = (
    ("Invalid Campaign ID", "reason_invalid_campaign"),
    ("Null Conversion", "reason_null_conversion"),
    ("Negative Spend", "reason_negative_spend"),
    ("Duplicate Record", "reason_duplicate"),
)

# first load date when no checkpoint exists
DEFAULT_CHECKPOINT = "1900-01-01"

# day-first date format of the raw source
RAW_DATE_FORMAT = "d/M/yyyy"


# ---------------------------------------------------------------------------
# Tunable rule thresholds (defaults equal the reference's)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoreRules:
    component_max: float = 25.0
    all_equal_score: float = 12.5
    excellent: float = 90.0
    good: float = 70.0
    average: float = 50.0
    high_performer_score: float = 70.0
    cpa_too_high_factor: float = 1.5


@dataclass(frozen=True)
class AnomalyRules:
    rolling_rows: int = 3
    ctr_drop_factor: float = 0.70
    cpa_spike_factor: float = 1.50
    spend_spike_factor: float = 3.0


@dataclass(frozen=True)
class ReportRules:
    high_concentration: float = 0.7
    medium_concentration: float = 0.5
    verdict_points: float = 5.0


@dataclass(frozen=True)
class Rules:
    score: ScoreRules = field(default_factory=ScoreRules)
    anomaly: AnomalyRules = field(default_factory=AnomalyRules)
    report: ReportRules = field(default_factory=ReportRules)


DEFAULT_RULES = Rules()

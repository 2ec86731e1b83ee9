"""Rows of the reference's exported tables. They must equal the exports.

Daily monitoring mart (34 rows):
campaign_id, date, impressions, clicks, spend, approved_conversion, ctr_pct,
cpa, cpm, conversion_rate_pct, ctr_3day_avg, cpa_3day_avg
"""

N = None

MONITORING = [
    ("1178", "2017-08-18", 809605.0, 130, 212.92, 3.0, 0.0161, 70.9733, 0.263, 2.3077, 0.0161, 70.9733),
    ("1178", "2017-08-19", 4863332.0, 790, 1260.21, 16.0, 0.0162, 78.7631, 0.2591, 2.0253, 0.0162, 74.8682),
    ("1178", "2017-08-20", 5254079.0, 797, 1365.48, 23.0, 0.0152, 59.3687, 0.2599, 2.8858, 0.0158, 69.7017),
    ("1178", "2017-08-21", 2803877.0, 413, 707.5, 15.0, 0.0147, 47.1667, 0.2523, 3.632, 0.0154, 61.7662),
    ("1178", "2017-08-22", 3235201.0, 395, 684.27, 20.0, 0.0122, 34.2135, 0.2115, 5.0633, 0.014, 46.9163),
    ("1178", "2017-08-23", 11857911.0, 1552, 2689.58, 80.0, 0.0131, 33.6197, 0.2268, 5.1546, 0.0133, 38.3333),
    ("1178", "2017-08-24", 5195760.0, 779, 1354.21, 22.0, 0.015, 61.555, 0.2606, 2.8241, 0.0134, 43.1294),
    ("1178", "2017-08-25", 9231379.0, 1174, 2053.59, 50.0, 0.0127, 41.0718, 0.2225, 4.2589, 0.0136, 45.4155),
    ("1178", "2017-08-26", 6021475.0, 838, 1438.15, 39.0, 0.0139, 36.8756, 0.2388, 4.6539, 0.0139, 46.5008),
    ("1178", "2017-08-27", 2029146.0, 293, 511.85, 10.0, 0.0144, 51.185, 0.2522, 3.413, 0.0137, 43.0441),
    ("1178", "2017-08-28", 5876705.0, 726, 1299.35, 42.0, 0.0124, 30.9369, 0.2211, 5.7851, 0.0136, 39.6658),
    ("1178", "2017-08-29", 8052549.0, 977, 1769.26, 41.0, 0.0121, 43.1527, 0.2197, 4.1965, 0.013, 41.7582),
    ("1178", "2017-08-30", 4671457.0, 713, 1230.79, 17.0, 0.0153, 72.3994, 0.2635, 2.3843, 0.0132, 48.8297),
    ("916", "2017-08-17", 182908.0, 39, 51.58, 8.0, 0.0213, 6.4475, 0.282, 20.5128, 0.0213, 6.4475),
    ("916", "2017-08-18", 110621.0, 22, 29.58, 6.0, 0.0199, 4.93, 0.2674, 27.2727, 0.0206, 5.6888),
    ("916", "2017-08-19", 30089.0, 6, 7.21, 1.0, 0.0199, 7.21, 0.2396, 16.6667, 0.0204, 6.1958),
    ("916", "2017-08-25", 1448.0, 0, 0.0, 1.0, 0.0, 0.0, 0.0, N, 0.0133, 4.0467),
    ("916", "2017-08-26", 32068.0, 12, 16.34, 0.0, 0.0374, N, 0.5095, 0.0, 0.0191, 3.605),
    ("916", "2017-08-27", 48387.0, 16, 21.91, 4.0, 0.0331, 5.4775, 0.4528, 25.0, 0.0235, 2.7388),
    ("916", "2017-08-29", 17527.0, 1, 1.51, 0.0, 0.0057, N, 0.0862, 0.0, 0.0254, 5.4775),
    ("916", "2017-08-30", 59877.0, 17, 21.58, 4.0, 0.0284, 5.395, 0.3604, 23.5294, 0.0224, 5.4362),
    ("936", "2017-08-18", 791939.0, 222, 311.35, 18.0, 0.028, 17.2972, 0.3931, 8.1081, 0.028, 17.2972),
    ("936", "2017-08-19", 831541.0, 215, 305.22, 27.0, 0.0259, 11.3044, 0.3671, 12.5581, 0.0269, 14.3008),
    ("936", "2017-08-20", 1045174.0, 260, 369.22, 18.0, 0.0249, 20.5122, 0.3533, 6.9231, 0.0263, 16.3713),
    ("936", "2017-08-21", 906820.0, 226, 323.72, 21.0, 0.0249, 15.4152, 0.357, 9.292, 0.0252, 15.744),
    ("936", "2017-08-22", 771592.0, 163, 237.82, 25.0, 0.0211, 9.5128, 0.3082, 15.3374, 0.0236, 15.1468),
    ("936", "2017-08-23", 902849.0, 193, 292.8, 20.0, 0.0214, 14.64, 0.3243, 10.3627, 0.0225, 13.1893),
    ("936", "2017-08-24", 290089.0, 63, 88.73, 11.0, 0.0217, 8.0664, 0.3059, 17.4603, 0.0214, 10.7397),
    ("936", "2017-08-25", 371119.0, 102, 146.5, 13.0, 0.0275, 11.2692, 0.3948, 12.7451, 0.0235, 11.3252),
    ("936", "2017-08-26", 1194350.0, 299, 470.61, 4.0, 0.025, 117.6525, 0.394, 1.3378, 0.0247, 45.6627),
    ("936", "2017-08-27", 278581.0, 66, 97.28, 6.0, 0.0237, 16.2133, 0.3492, 9.0909, 0.0254, 48.3784),
    ("936", "2017-08-28", 270171.0, 62, 90.32, 6.0, 0.0229, 15.0533, 0.3343, 9.6774, 0.0239, 49.6397),
    ("936", "2017-08-29", 332923.0, 78, 110.54, 6.0, 0.0234, 18.4233, 0.332, 7.6923, 0.0234, 16.5633),
    ("936", "2017-08-30", 141039.0, 35, 49.26, 8.0, 0.0248, 6.1575, 0.3493, 22.8571, 0.0237, 13.2114),
]

MONITORING_SCHEMA = (
    "campaign_id string, date string, impressions double, clicks long, spend double, "
    "approved_conversion double, ctr_pct double, cpa double, cpm double, "
    "conversion_rate_pct double, ctr_3day_avg double, cpa_3day_avg double")

# KPI mart: campaign_id, total_impressions, total_clicks, total_spend,
# total_conversions, total_approved_conv, fact_rows, ctr_pct, cpc, cpa,
# conversion_rate_pct, cpm
KPIS = [
    ("1178", 69902476.0, 9577.0, 16577.16, 1050.0, 378.0, 28, 0.0137, 1.7309, 43.8549, 3.947, 0.2371),
    ("916", 482925.0, 113.0, 149.71, 58.0, 24.0, 19, 0.0234, 1.3249, 6.2379, 21.2389, 0.31),
    ("936", 8128187.0, 1984.0, 2893.37, 537.0, 183.0, 86, 0.0244, 1.4584, 15.8108, 9.2238, 0.356),
]
KPIS_SCHEMA = (
    "campaign_id string, total_impressions double, total_clicks double, total_spend double, "
    "total_conversions double, total_approved_conv double, fact_rows int, ctr_pct double, "
    "cpc double, cpa double, conversion_rate_pct double, cpm double")

# scores, health score, label, tier, recommendation per campaign
KPI_SCORES = {
    "1178": (0.0, 0.0, 0.0, 25.0, 25.0, "Poor", "Poor Performer",
             "Review / Pause - High spend with low conversion rate"),
    "916": (22.663551401869157, 25.0, 25.0, 9.671993271656854, 82.34, "Good", "High Performer",
            "Scale Budget - Strong efficiency and conversion rate"),
    "936": (25.0, 7.629005488118715, 18.637916367599757, 0.0, 51.27, "Average",
            "Standard Performer",
            "Optimize - Test new audiences or ad creatives to improve CPA"),
}

# campaign summary: top strength and biggest risk
SUMMARY = {
    "1178": ("CPM Efficiency", "Low click-through rate — ad relevance may be weak"),
    "916": ("Conversion Rate", "High cost per thousand impressions — expensive reach"),
    "936": ("CTR", "High cost per thousand impressions — expensive reach"),
}

# anomaly log: campaign_id, date, anomaly_type, severity, metric_value, baseline, description
ANOMALIES = [
    ("916", "2017-08-25", "CTR_DROP", "HIGH", 0.0, 0.0133,
     "CTR dropped 100.0% below 3-day average (0.0000% vs baseline 0.0133%)"),
    ("916", "2017-08-26", "ZERO_CONVERSIONS", "HIGH", 0.0, N,
     "Zero approved conversions despite $16.34 spend"),
    ("916", "2017-08-27", "CPA_SPIKE", "HIGH", 5.4775, 2.7388,
     "CPA spiked 100.0% above 3-day average ($5.48 vs baseline $2.74)"),
    ("916", "2017-08-29", "CTR_DROP", "HIGH", 0.0057, 0.0254,
     "CTR dropped 77.6% below 3-day average (0.0057% vs baseline 0.0254%)"),
    ("916", "2017-08-29", "ZERO_CONVERSIONS", "HIGH", 0.0, N,
     "Zero approved conversions despite $1.51 spend"),
    ("936", "2017-08-26", "CPA_SPIKE", "HIGH", 117.6525, 45.6627,
     "CPA spiked 157.7% above 3-day average ($117.65 vs baseline $45.66)"),
]

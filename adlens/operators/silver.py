"""Silver layer (T1–T5): campaign and audience dimensions, the daily fact.

All three are single ``groupBy`` aggregations over bronze. Each is planned as
partial (map-side) aggregation, one shuffle on the grouping keys, final
aggregation — so a hot campaign or date is collapsed on the map side before
anything moves. ``COUNT(DISTINCT fb_campaign_id)`` is planned the same way
on (campaign, fb_campaign_id) first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from adlens.config import AGE_GROUPS, GENDERS
from adlens.functions import money_sum, round_half_away
from adlens.functions.expr import merged_money, money_parts


FACT_SCHEMA = StructType([
    StructField("campaign_id", StringType()),
    StructField("date", DateType()),
    StructField("audience_id", StringType()),
    StructField("impressions", DoubleType()),
    StructField("clicks", LongType()),
    StructField("spend", DoubleType()),
    StructField("total_conversion", DoubleType()),
    StructField("approved_conversion", DoubleType()),
    StructField("ad_count", LongType()),
])


def standard_audience(ages=AGE_GROUPS, genders=GENDERS):
    return F.col("age").isin(*ages) & F.col("gender").isin(*genders)


def audience_id():
    return F.concat(F.col("age"), F.lit("_"), F.col("gender"))


def dim_campaign(bronze: DataFrame) -> DataFrame:
    """One row per campaign — distinct FB campaigns, rows, first/last date."""
    return (bronze.groupBy("campaign_id").agg(
        F.countDistinct("fb_campaign_id").alias("distinct_fb_campaigns"),
        F.count(F.lit(1)).alias("total_ad_rows"),
        F.min("reporting_start").alias("first_seen_date"),
        F.max("reporting_start").alias("last_seen_date"),
    ))


def campaign_ads(bronze: DataFrame) -> DataFrame:
    """T1 by month, to be merged by ``dim_campaign_from``: the FB campaigns of each campaign, with
    their rows, first and last date. Distinct counts add up only over distinct values, so these are kept."""
    return (bronze.groupBy(F.date_format("reporting_start", "yyyy-MM").alias("month"), "campaign_id", "fb_campaign_id")
            .agg(F.count(F.lit(1)).alias("ad_rows"), F.min("reporting_start").alias("first_date"),
                 F.max("reporting_start").alias("last_date")))


def dim_campaign_from(ads: DataFrame) -> DataFrame:
    """T1 from the months' ``campaign_ads``."""
    return ads.groupBy("campaign_id").agg(
        F.countDistinct("fb_campaign_id").alias("distinct_fb_campaigns"),
        F.sum("ad_rows").alias("total_ad_rows"),
        F.min("first_date").alias("first_seen_date"),
        F.max("last_date").alias("last_seen_date"),
    )


def dim_audience(bronze: DataFrame, ages=AGE_GROUPS, genders=GENDERS) -> DataFrame:
    """One row per standard age × gender pair, keyed ``age_gender``.

    At most |ages| × |genders| rows, whatever the data size.
    """
    return (bronze.where(standard_audience(ages, genders))
            .groupBy("age", "gender").agg(F.count(F.lit(1)).alias("_n"))
            .select(audience_id().alias("audience_id"),
                    F.col("age").alias("age_group"), "gender"))


def fact_campaign_performance(bronze: DataFrame, ages=AGE_GROUPS, genders=GENDERS) -> DataFrame:
    """Sums per campaign × date × audience; spend exact, rounded to 4 dp."""
    return (bronze.where(standard_audience(ages, genders))
            .groupBy("campaign_id", F.col("reporting_start").alias("date"), "age", "gender")
            .agg(F.sum("impressions").alias("impressions"),
                 F.sum("clicks").alias("clicks"),
                 round_half_away(money_sum("spent"), 4).alias("spend"),
                 F.sum("total_conversion").alias("total_conversion"),
                 F.sum("approved_conversion").alias("approved_conversion"),
                 F.count(F.lit(1)).alias("ad_count"))
            .select("campaign_id", "date", audience_id().alias("audience_id"),
                    "impressions", "clicks", "spend", "total_conversion",
                    "approved_conversion", "ad_count"))


def fact_sanity(fact: DataFrame) -> DataFrame:
    """T4: row count, distinct campaigns/dates/audiences and three totals."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("campaign_id").alias("campaigns"),
        F.countDistinct("date").alias("dates"),
        F.countDistinct("audience_id").alias("audiences"),
        round_half_away(money_sum("spend"), 2).alias("total_spend"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("approved_conversion").alias("total_approved_conv"),
    )


def fact_totals(fact: DataFrame) -> DataFrame:
    """The fact's sums by month, campaign and audience: what T4, T5, M1–M6 and T2 are merged from.

    Money keeps its exact part and its rest apart, so merged sums equal those over the fact.
    """
    return (fact.groupBy(F.date_format("date", "yyyy-MM").alias("month"), "campaign_id", "audience_id")
            .agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"),
                 *money_parts("spend", "spend"),
                 F.sum("total_conversion").alias("total_conversion"),
                 F.sum("approved_conversion").alias("approved_conversion"),
                 F.count(F.lit(1)).alias("fact_rows"), F.count_if(_negative()).alias("negative_rows")))


def dim_audience_from(totals: DataFrame) -> DataFrame:
    """T2 from the months' totals: every audience that has a fact row."""
    gender = F.substring_index("audience_id", "_", -1)
    age = F.substring("audience_id", F.lit(1), F.length("audience_id") - F.length(gender) - 1)
    return totals.select("audience_id").distinct().select("audience_id", age.alias("age_group"), gender.alias("gender"))


def sanity_from(totals: DataFrame, dates: int) -> DataFrame:
    """T4 and T5 from the months' totals; the number of dates is counted where there is a row a date."""
    return totals.agg(
        F.coalesce(F.sum("fact_rows"), F.lit(0)).alias("total_rows"),
        F.countDistinct("campaign_id").alias("campaigns"),
        F.lit(dates).cast("long").alias("dates"),
        F.countDistinct("audience_id").alias("audiences"),
        round_half_away(merged_money("spend"), 2).alias("total_spend"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("approved_conversion").alias("total_approved_conv"),
        F.coalesce(F.sum("negative_rows"), F.lit(0)).alias("negative_rows"),
    )


def _negative():
    return (F.col("spend") < 0) | (F.col("clicks") < 0) | (F.col("impressions") < 0)


def fact_negative_rows(fact: DataFrame) -> DataFrame:
    """T5: number of fact rows with a negative spend, click or impression sum."""
    return fact.agg(F.count_if(_negative()).alias("negative_rows"))

"""Raw ad rows built from the driver's test tables.

These adapters only shape test-table rows into the raw ad-row schema (all
text, plus a source-order key). They do none of the pipeline's work: no
validation, no aggregation of ad metrics, no KPI. Every job downstream
treats their output as it would treat any CSV of that schema.

Mapping ``lineitem`` → ad rows (one ad row per line item):

* ad_id = l_suppkey*10 + l_linenumber; both report dates = ship date
* campaign_id: discount 0 → '45-49' (a column-shifted row); else return
  flag A/R/N → 916/936/1178
* fb_campaign_id = l_partkey; age from l_suppkey % 5 (4 → '50-54');
  gender from the line status (F → F, O → M)
* impressions = quantity*1000; clicks = l_partkey % 40;
  spent = extended price, negated when discount 0.1 and quantity > 45
* both conversions NULL when tax 0.08, else linenumber and
  max(linenumber-5, 0)
* source order = (orderkey, linenumber, shipdate, partkey, suppkey, price)

Mapping ``events`` → ad rows (one row per user per day), for the
incremental load: views → impressions, clicks → clicks, signups+purchases →
total conversions, purchases → approved conversions, summed value of views
and clicks → spent (NULL when there is none).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.config import AGE_GROUPS, RAW_COLUMNS
from adlens.sources.raw import SEQ

# age bracket outside the standard four (dropped by the silver layer)
OTHER_AGE = "50-54"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _pick(key: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key + 1).cast("int"))


def ad_rows_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_to_ad_rows(table(spark, sf_dir, "lineitem"))


def lineitem_to_ad_rows(li: DataFrame) -> DataFrame:
    """Row-by-row shaping (no state), so it applies to a stream as well."""
    disc, qty, tax = F.col("l_discount"), F.col("l_quantity"), F.col("l_tax")
    day = F.date_format(F.col("l_shipdate"), "dd/MM/yyyy")
    campaign = (F.when(disc == 0, F.lit("45-49"))
                .when(F.col("l_returnflag") == "A", F.lit("916"))
                .when(F.col("l_returnflag") == "R", F.lit("936"))
                .when(F.col("l_returnflag") == "N", F.lit("1178")))
    no_conv = tax == 0.08
    spent = F.when((disc == 0.1) & (qty > 45), -F.col("l_extendedprice")).otherwise(
        F.col("l_extendedprice"))
    cols = {
        "ad_id": _text(F.col("l_suppkey") * 10 + F.col("l_linenumber")),
        "reporting_start": day,
        "reporting_end": day,
        "campaign_id": campaign,
        "fb_campaign_id": _text(F.col("l_partkey")),
        "age": _pick(F.col("l_suppkey") % 5, AGE_GROUPS + (OTHER_AGE,)),
        "gender": F.when(F.col("l_linestatus") == "F", F.lit("F")).otherwise(F.lit("M")),
        "interest1": _text(F.col("l_partkey") % 100),
        "interest2": _text(F.col("l_suppkey") % 100),
        "interest3": _text(F.col("l_linenumber")),
        "impressions": _text((qty * 1000).cast("bigint")),
        "clicks": _text((F.col("l_partkey") % 40).cast("int")),
        "spent": _text(spent.cast("decimal(18,2)")),
        "total_conversion": F.when(~no_conv, _text(F.col("l_linenumber"))),
        "approved_conversion": F.when(
            ~no_conv, _text(F.greatest(F.col("l_linenumber") - 5, F.lit(0)))),
    }
    seq = F.struct("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey",
                   "l_suppkey", "l_extendedprice")
    return li.select(*[cols[c].alias(c) for c in RAW_COLUMNS], seq.alias(SEQ))


def ad_rows_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    day = F.to_date(F.col("ts"))
    daily = ev.groupBy(F.col("user_id"), day.alias("day")).agg(
        F.count_if(et == "view").alias("views"),
        F.count_if(et == "click").alias("clicks"),
        F.count_if(et.isin("signup", "purchase")).alias("conv"),
        F.count_if(et == "purchase").alias("approved"),
        F.sum(F.when(et.isin("view", "click"), F.col("value"))).alias("spent"),
    )
    u = F.col("user_id")
    text_day = F.date_format(F.col("day"), "dd/MM/yyyy")
    cols = {
        "ad_id": _text(u),
        "reporting_start": text_day,
        "reporting_end": text_day,
        "campaign_id": _pick(u % 3, ("916", "936", "1178")),
        "fb_campaign_id": _text(u % 10),
        "age": _pick(u % 4, AGE_GROUPS),
        "gender": _pick(u % 2, ("M", "F")),
        "interest1": _text(u % 100),
        "interest2": _text(u % 50),
        "interest3": _text(u % 25),
        "impressions": _text(F.col("views")),
        "clicks": _text(F.col("clicks")),
        "spent": _text(F.col("spent").cast("decimal(18,2)")),
        "total_conversion": _text(F.col("conv")),
        "approved_conversion": _text(F.col("approved")),
    }
    return daily.select(*[cols[c].alias(c) for c in RAW_COLUMNS],
                        F.struct("day", "user_id").alias(SEQ))

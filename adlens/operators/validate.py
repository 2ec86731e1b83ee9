"""Validation layer (V1–V10): four rejection rules, rejection log, run summary.

Rules, in order (the first failing rule names the row's reason):

1. ``campaign_id`` not in the allowed set (a missing id fails too);
2. both conversion columns missing or not numeric;
3. spend below zero (a missing spend passes);
4. a second or later row with the same (``ad_id``, ``reporting_start``) in
   source order. Duplicates are counted over all rows, rejected ones
   included; keys are compared as text and a missing key part equals
   another missing one.

Scale: rule 4 needs, per row, "is there an earlier row with my key?". A
window partitioned by the key would sort every row of a hot key (one key
may hold a third of the rows) in one task. Instead:

1. rows per 64-bit hash of the key — a hash aggregation, partial per task, so a hot
   key is collapsed on the map side before the shuffle, and a key that is met once moves
   as two numbers, not as its text;
2. the hashes met more than once as marks in a bitmap of ``MARKS`` places, which every
   task gets: its size has a bound, whatever the number of such hashes;
3. rows without a mark are the only ones of their key and are done, where they were read.
   Rows with a mark are those of repeated keys, and a few others that share a mark;
4. the first source position of each repeated key, aggregated over the marked rows; keys
   are compared in full here, so two keys of one hash or mark stay apart;
5. every marked row is joined (left, null-safe on the key) to step 4; it is a
   duplicate when its position is not the first one.

With an index of the keys of earlier loads (``seen``), a row whose key is in it is
a duplicate as well.

Steps 4–5 only move marked rows plus one row per repeated key. When nearly all keys are
repeated these are nearly all rows; the join then is a sort-merge join, and AQE's
skew-join handling splits the partitions of a hot key on the row side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.config import (
    RAW_COLUMNS,
    REASON_DUPLICATE,
    REASON_INVALID_CAMPAIGN,
    REASON_NEGATIVE_SPEND,
    REASON_NULL_CONVERSION,
    VALID_CAMPAIGN_IDS,
)
from adlens.functions import clean_number, round_half_away
from adlens.sources.raw import SEQ

DEDUP_KEY = ("ad_id", "reporting_start")
REASON = "rejection_reason"
MARKS = 1 << 25  # places of the bitmap that tells which rows may have a repeated key: 4 MB


# -- single rules -------------------------------------------------------------

# Lists of more ids than this are joined as a table instead of written into the plan.
LISTED_IDS = 100


def with_allowed(raw: DataFrame, campaign_ids=VALID_CAMPAIGN_IDS, flag: str = "_allowed") -> DataFrame:
    """V1: flag rows whose id is in the allowed set; NULL counts as not allowed.

    ``campaign_ids`` are the ids, or a DataFrame whose first column holds them.
    A long list becomes a join; how is left to the size Spark sees.
    """
    if not isinstance(campaign_ids, DataFrame):
        ids = [str(c) for c in campaign_ids]
        if len(ids) <= LISTED_IDS:
            known = F.col("campaign_id").isin(*ids) if ids else F.lit(False)
            return raw.withColumn(flag, F.coalesce(known, F.lit(False)))
        campaign_ids = raw.sparkSession.createDataFrame([(c,) for c in ids], "id string")
    listed = campaign_ids.select(F.col(campaign_ids.columns[0]).cast("string").alias("_listed")).distinct()
    return (raw.join(listed, F.col("campaign_id") == F.col("_listed"), "left")
            .withColumn(flag, F.col("_listed").isNotNull()).drop("_listed"))


def invalid_campaign(campaign_ids=VALID_CAMPAIGN_IDS) -> Column:
    """V1 as an expression, for a short list of ids."""
    return ~F.coalesce(F.col("campaign_id").isin(*campaign_ids), F.lit(False))


def null_conversion() -> Column:
    """V2+V3: both conversions missing once read as numbers."""
    return (clean_number("total_conversion").isNull()
            & clean_number("approved_conversion").isNull())


def negative_spend() -> Column:
    """V4: numeric spend below zero; missing or non-numeric spend passes."""
    return F.coalesce(clean_number("spent") < 0, F.lit(False))


def with_duplicate_flag(raw: DataFrame, key=DEDUP_KEY, seq: str = SEQ,
                        flag: str = "_is_dup", seen: DataFrame | None = None) -> DataFrame:
    """V5: flag every row that is not the first of its key in source order.

    ``seen`` holds the keys of earlier rows, each once, under the names in ``key``.
    """
    fk = [f"_dk_{i}" for i in range(len(key))]

    def on_key(right: DataFrame):
        return [F.col(k).eqNullSafe(right[n]) for k, n in zip(key, fk)]

    # hashes met more than once: hash aggregation, partial per task first
    hashed = F.xxhash64(*key)
    word, bit = F.shiftright("_h", 6).bitwiseAND(F.lit(MARKS // 64 - 1)), F.col("_h").bitwiseAND(F.lit(63)).cast("int")
    marks = (raw.groupBy(hashed.alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit"))
             .groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    with_hash = raw.withColumn("_h", hashed)
    marked = (word == F.col("_word")) & (F.getbit("_bits", bit) == 1)
    once = with_hash.join(F.broadcast(marks), marked, "left_anti").drop("_h")
    some = with_hash.join(F.broadcast(marks), marked, "left_semi").drop("_h")
    # first source position of each repeated key, from the marked rows only
    firsts = (some.groupBy(*[F.col(k).alias(n) for k, n in zip(key, fk)])
              .agg(F.min(seq).alias("_first_seq"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    joined = some.join(firsts, on_key(firsts), "left")
    repeated = F.coalesce(F.col(seq) != F.col("_first_seq"), F.lit(False))
    flagged = (joined.select(*raw.columns, repeated.alias(flag))
               .unionByName(once.select(*raw.columns, F.lit(False).alias(flag))))
    if seen is None:
        return flagged
    known = seen.select(*[F.col(k).alias(f"_seen_{n}") for k, n in zip(key, fk)], F.lit(True).alias("_seen"))
    met = flagged.join(known, [F.col(k).eqNullSafe(F.col(f"_seen_{n}")) for k, n in zip(key, fk)], "left")
    return met.select(*raw.columns, (F.col(flag) | F.coalesce("_seen", F.lit(False))).alias(flag))


def with_rejection_reason(raw: DataFrame, campaign_ids=VALID_CAMPAIGN_IDS, seen: DataFrame | None = None) -> DataFrame:
    """V6: one reason per row, first failing rule wins; NULL for valid rows."""
    flagged = with_allowed(with_duplicate_flag(raw, seen=seen), campaign_ids)
    reason = (F.when(~F.col("_allowed"), F.lit(REASON_INVALID_CAMPAIGN))
              .when(null_conversion(), F.lit(REASON_NULL_CONVERSION))
              .when(negative_spend(), F.lit(REASON_NEGATIVE_SPEND))
              .when(F.col("_is_dup"), F.lit(REASON_DUPLICATE)))
    return flagged.withColumn(REASON, reason).drop("_is_dup", "_allowed")


# -- split, log, summary --------------------------------------------------------

def valid_rows(checked: DataFrame) -> DataFrame:
    """V7: rows that passed every rule (raw text columns and source order)."""
    return checked.where(F.col(REASON).isNull()).drop(REASON)


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull())


def raw_row_json() -> Column:
    """The raw row as a JSON object, missing values as JSON null."""
    return F.to_json(F.struct(*[F.col(c) for c in RAW_COLUMNS]),
                     {"ignoreNullFields": "false"})


def validation_log(checked: DataFrame, rejected_at=None) -> DataFrame:
    """V8: one row per rejected row with its reason and raw text."""
    cols = [F.col("ad_id"), F.col("reporting_start"), F.col("campaign_id"),
            F.col(REASON), raw_row_json().alias("raw_row")]
    if rejected_at is not None:
        cols.append(F.lit(rejected_at).cast("timestamp").alias("rejected_at"))
    return rejected_rows(checked).select(*cols)


def validation_summary(checked: DataFrame, run_timestamp=None) -> DataFrame:
    """V9: one row — totals, share rejected (2 dp) and the count per reason.

    A single global aggregate: each task counts its rows, one final task adds
    up one partial row per task.
    """
    r = F.col(REASON)
    agg = checked.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(r.isNull()).alias("valid_rows"),
        F.count_if(r.isNotNull()).alias("rejected_rows"),
        F.count_if(r == REASON_INVALID_CAMPAIGN).alias("reason_invalid_campaign"),
        F.count_if(r == REASON_NULL_CONVERSION).alias("reason_null_conversion"),
        F.count_if(r == REASON_NEGATIVE_SPEND).alias("reason_negative_spend"),
        F.count_if(r == REASON_DUPLICATE).alias("reason_duplicate"),
    )
    pct = F.when(F.col("total_rows") > 0, round_half_away(
        F.col("rejected_rows") / F.col("total_rows") * 100, 2)).otherwise(F.lit(0.0))
    cols = ["total_rows", "valid_rows", "rejected_rows", pct.alias("pct_rejected"),
            "reason_invalid_campaign", "reason_null_conversion",
            "reason_negative_spend", "reason_duplicate"]
    if run_timestamp is not None:
        cols.insert(0, F.lit(run_timestamp).cast("timestamp").alias("run_timestamp"))
    return agg.select(*cols)


def rejection_breakdown(checked: DataFrame) -> DataFrame:
    """Rejected rows per reason, most frequent first."""
    return (rejected_rows(checked).groupBy(REASON).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(REASON)))


@dataclass
class Validated:
    checked: DataFrame

    @property
    def valid(self) -> DataFrame:
        return valid_rows(self.checked)

    @property
    def rejected(self) -> DataFrame:
        return rejected_rows(self.checked)


def validate(raw: DataFrame, campaign_ids=VALID_CAMPAIGN_IDS) -> Validated:
    return Validated(with_rejection_reason(raw, campaign_ids))

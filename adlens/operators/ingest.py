"""Incremental load into bronze.

* I1 the watermark is the last loaded date; absent or unparsable means
  1900-01-01.
* I2 keep rows of allowed campaigns (rule 1 only, as the reference does;
  ``rules="all"`` loads only rows that pass all four rules instead).
* I3 day-first date parse; unparsable text stops the job.
* I4 keep rows strictly newer than the watermark.
* I5 stamp ``loaded_at``, fix the column list, write.
* I6 an empty batch writes no row and keeps the watermark.
* I7 the new watermark is the batch's latest date, written after the data.

Bronze is a versioned table (``adlens.versions``) by month of ``reporting_start``. An
increment is written into folders of its own and becomes part of bronze by one commit,
which also moves the watermark and numbers the increment (``seq``), so a load counts as
a whole or not at all. Reading looks at one commit: it does not list increments, and
reading from a month on leaves out the folders of earlier ones. Tables that are derived
from bronze keep the ``seq`` up to which they have it and so find the months they lack.
``compact`` joins a month's folders once they are many. Rows are dealt by month with a
rebalance, which splits a month that holds very many rows and joins small ones.

The watermark file is a versioned table without data. What counts is the later of its
date and the date in bronze's commit, so neither a crash between the two nor a lost
watermark loads rows twice.

With ``rules="all"`` duplicates (rule 4) are told over all loads: every load adds the
keys of its rows, rejected ones included, to an index that is part of the same commit. A
load reads the index only of the months that its rows name. The index begins with
the first load under ``rules="all"``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from adlens.config import DEFAULT_CHECKPOINT, RAW_DATE_FORMAT, VALID_CAMPAIGN_IDS
from adlens.functions import clean_number, parse_day_first, whole_number
from adlens.operators.validate import DEDUP_KEY, with_allowed, with_rejection_reason
from adlens.versions import MONTH, Commit, Folder, VersionedTable

BRONZE_SCHEMA = StructType([
    StructField("ad_id", LongType()),
    StructField("reporting_start", DateType()),
    StructField("reporting_end", DateType()),
    StructField("campaign_id", StringType()),
    StructField("fb_campaign_id", StringType()),
    StructField("age", StringType()),
    StructField("gender", StringType()),
    StructField("interest1", LongType()),
    StructField("interest2", LongType()),
    StructField("interest3", LongType()),
    StructField("impressions", DoubleType()),
    StructField("clicks", LongType()),
    StructField("spent", DoubleType()),
    StructField("total_conversion", DoubleType()),
    StructField("approved_conversion", DoubleType()),
    StructField("loaded_at", TimestampType()),
])
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]
KEYS = "keys"  # kind of the folders that hold the index of seen keys
KEY_SCHEMA = StructType([StructField(k, StringType()) for k in DEDUP_KEY])
MOST_FOLDERS = 64  # of a month, before they are joined


# -- the watermark (I1, I7) -------------------------------------------------------------

def month_of(date):
    return F.date_format(date, "yyyy-MM")


def _date_or_none(text) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text)
    except (TypeError, ValueError):
        return None


def read_checkpoint(spark: SparkSession, path: str, bronze_path: str | None = None) -> dt.date:
    """Last loaded date; 1900-01-01 if none or if it is no date. No Spark job.

    With ``bronze_path`` the date that bronze's last commit holds counts as well.
    """
    found = [VersionedTable(spark, path).current().state.get("last_loaded_date")]
    if bronze_path is not None:
        found.append(VersionedTable(spark, bronze_path).current().state.get("last"))
    dates = [d for d in map(_date_or_none, found) if d is not None]
    return max([dt.date.fromisoformat(DEFAULT_CHECKPOINT), *dates])


def write_checkpoint(spark: SparkSession, path: str, last: dt.date) -> None:
    """The date as the watermark's next version."""
    table = VersionedTable(spark, path)
    table.commit(table.current(), [], state={"last_loaded_date": last.isoformat()})


def next_checkpoint(new_rows: DataFrame) -> DataFrame:
    """The batch's latest date as a one-row frame (NULL for an empty batch)."""
    return new_rows.agg(F.max("reporting_start").alias("last_loaded_date"))


# -- typed new rows (I2–I4) -------------------------------------------------------

def _int(c: str):
    return clean_number(c).cast("bigint")


def parsed_dates(raw: DataFrame) -> DataFrame:
    """Raw rows with both report dates parsed (day first)."""
    return (raw.withColumn("reporting_start", parse_day_first("reporting_start", "reporting_start"))
            .withColumn("reporting_end", parse_day_first("reporting_end", "reporting_end")))


def typed_rows(raw: DataFrame) -> DataFrame:
    """Raw text rows cast to the bronze column types (without ``loaded_at``)."""
    d = parsed_dates(raw)
    return d.select(
        whole_number("ad_id").alias("ad_id"),
        "reporting_start", "reporting_end",
        "campaign_id", "fb_campaign_id", "age", "gender",
        _int("interest1").alias("interest1"),
        _int("interest2").alias("interest2"),
        _int("interest3").alias("interest3"),
        clean_number("impressions").alias("impressions"),
        _int("clicks").alias("clicks"),
        clean_number("spent").alias("spent"),
        clean_number("total_conversion").alias("total_conversion"),
        clean_number("approved_conversion").alias("approved_conversion"),
    )


def allowed_rows(raw: DataFrame, rules: str = "campaign",
                 campaign_ids=VALID_CAMPAIGN_IDS, seen: DataFrame | None = None) -> DataFrame:
    """Typed rows of allowed campaigns (or of fully valid rows)."""
    if rules == "all":
        kept = with_rejection_reason(raw, campaign_ids, seen).where(
            F.col("rejection_reason").isNull())
    elif rules == "campaign":
        kept = with_allowed(raw, campaign_ids).where("_allowed")
    else:
        raise ValueError(f"rules must be 'campaign' or 'all', not {rules!r}")
    return typed_rows(kept)


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def newer_than(last_loaded):
    """I4: strictly after the watermark."""
    return F.col("reporting_start") > F.lit(_as_date(last_loaded))


def incremental_new_rows(raw: DataFrame, last_loaded, rules: str = "campaign",
                         campaign_ids=VALID_CAMPAIGN_IDS, seen: DataFrame | None = None) -> DataFrame:
    """Typed rows of allowed campaigns dated after ``last_loaded``."""
    return allowed_rows(raw, rules, campaign_ids, seen).where(newer_than(last_loaded))


def stamp(new_rows: DataFrame, loaded_at) -> DataFrame:
    """Add ``loaded_at`` and fix the bronze column order (K6)."""
    return new_rows.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp")).select(*BRONZE_COLUMNS)


# -- keys seen by earlier loads (V5 over all loads) ---------------------------------------

def key_month():
    """The month that a raw row's date text names; ``none`` where it is no date."""
    day = F.coalesce(F.try_to_date("reporting_start", RAW_DATE_FORMAT), F.try_to_date("reporting_start", "yyyy-MM-dd"))
    return F.coalesce(month_of(day), F.lit("none"))


def seen_keys(table: VersionedTable, at: Commit, raw: DataFrame) -> DataFrame:
    """The indexed keys of the months that ``raw`` names (few: their names are read to the driver)."""
    held = {f.month for f in at.folders if f.kind == KEYS}
    months = [r[0] for r in raw.select(key_month().alias("m")).distinct().collect()] if held else []
    return table.read(at, months, KEY_SCHEMA, KEYS)


def write_keys(table: VersionedTable, raw: DataFrame, seen: DataFrame, seq: int) -> list[Folder]:
    """The keys of ``raw`` that are not indexed yet, as folders not yet part of the table."""
    name = table.new_folder()
    # a hot key is one row for each task before anything moves
    keys = raw.select(*DEDUP_KEY, key_month().alias(MONTH)).distinct()
    known = seen.select(*[F.col(k).alias(f"_{k}") for k in DEDUP_KEY])
    new = keys.join(known, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in DEDUP_KEY], "left_anti")
    new.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{table.path}/{name}")
    return table.written_months(name, seq, KEYS)


# -- the load (I5–I7) ---------------------------------------------------------------

def add_increment(spark: SparkSession, raw: DataFrame, bronze_path: str, last_loaded, loaded_at,
                  rules: str = "campaign", campaign_ids=VALID_CAMPAIGN_IDS, state_of=None) -> dict:
    """The new rows of ``raw`` as one increment of bronze, by one commit.

    ``state_of(state, stats)`` gives the state that the commit carries; without it the
    state keeps the latest date of the increment. Returns ``{"n": rows, "last": latest
    date, "null_ids": rows whose ad_id is no whole number}``, observed on the write.
    """
    table = VersionedTable(spark, bronze_path)
    base = table.current()
    seq = base.state.get("seq", 0) + 1
    seen = seen_keys(table, base, raw) if rules == "all" else None
    rows = incremental_new_rows(raw, last_loaded, rules, campaign_ids, seen)
    name, seen_on_write = table.new_folder(), Observation()
    (stamp(rows, loaded_at).withColumn(MONTH, month_of("reporting_start")).hint("rebalance", MONTH)
     .observe(seen_on_write, F.count(F.lit(1)).alias("n"), F.max("reporting_start").alias("last"),
              F.count_if(F.col("ad_id").isNull()).alias("null_ids"))
     .write.partitionBy(MONTH).parquet(f"{table.path}/{name}"))
    stats = dict(seen_on_write.get)
    added = table.written_months(name, seq) if stats["n"] else []
    if rules == "all":
        added += write_keys(table, raw, seen, seq)
    state = {**base.state, "seq": seq, "lineage": base.state.get("lineage") or uuid.uuid4().hex}
    if state_of is not None:
        state = state_of(state, stats)
    elif stats["n"]:  # I6: else nothing was loaded and the watermark stays
        state["last"] = max(filter(None, [state.get("last"), stats["last"].isoformat()]))
    if added or state_of is not None:
        table.commit(base, [*base.folders, *added], BRONZE_SCHEMA, state)
    compact(spark, bronze_path)
    return stats


def load_increment(spark: SparkSession, raw: DataFrame, bronze_path: str,
                   checkpoint_path: str, loaded_at=None, rules: str = "campaign",
                   campaign_ids=VALID_CAMPAIGN_IDS) -> dict:
    """Append the rows newer than the watermark to bronze; advance the watermark.

    Returns ``{"last_loaded": date, "inserted": n, "new_checkpoint": date|None,
    "null_ids": n}``.
    """
    last = read_checkpoint(spark, checkpoint_path, bronze_path)
    stats = add_increment(spark, raw, bronze_path, last, loaded_at or dt.datetime.now(), rules, campaign_ids)
    if stats["n"]:
        write_checkpoint(spark, checkpoint_path, stats["last"])
    return {"last_loaded": last, "inserted": stats["n"], "new_checkpoint": stats["last"],
            "null_ids": stats["null_ids"]}


def compact(spark: SparkSession, bronze_path: str, most: int = MOST_FOLDERS) -> int:
    """Join the folders of months that have more than ``most`` into one; returns how many months.

    The rows and the number of the last load of a month stay, so derived tables see no
    change; readers keep the folders they looked up until ``vacuum``.
    """
    table = VersionedTable(spark, bronze_path)
    base = table.current()
    held: dict[tuple[str, str], list[Folder]] = {}
    for f in base.folders:
        held.setdefault((f.kind, f.month), []).append(f)
    many = {k: fs for k, fs in held.items() if len(fs) > most}
    folders = [f for f in base.folders if (f.kind, f.month) not in many]
    for kind in sorted({k for k, _ in many}):
        months = [m for k, m in many if k == kind]
        schema = KEY_SCHEMA if kind == KEYS else BRONZE_SCHEMA
        rows = table.read(base, months, schema, kind)
        name = table.new_folder()
        month = key_month() if kind == KEYS else month_of("reporting_start")
        rows.withColumn(MONTH, month).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{table.path}/{name}")
        folders += [Folder(f.path, f.month, max(x.seq for x in many[kind, f.month]), kind) for f in table.written_months(name)]
    if many:
        table.commit(base, folders)
    return len(many)


def reset_load(spark: SparkSession, bronze_path: str, checkpoint_path: str) -> None:
    """Start the incremental load over: rewind the watermark and empty bronze.

    The watermark goes first: a reset that dies in between leaves the rows that bronze
    still holds counted. Tables derived from bronze see that it began anew.
    """
    write_checkpoint(spark, checkpoint_path, dt.date.fromisoformat(DEFAULT_CHECKPOINT))
    table = VersionedTable(spark, bronze_path)
    base = table.current()
    table.commit(base, [], BRONZE_SCHEMA, {"seq": base.state.get("seq", 0), "lineage": uuid.uuid4().hex})


def read_bronze(spark: SparkSession, bronze_path: str, from_month_of: dt.date | None = None) -> DataFrame:
    """Bronze with its declared schema; empty (same schema) before the first load.

    ``from_month_of`` leaves out the folders of months before that date's.
    """
    table = VersionedTable(spark, bronze_path)
    at = table.current()
    months = None if from_month_of is None else [m for m in at.months() if m >= f"{from_month_of:%Y-%m}"]
    return table.read(at, months, BRONZE_SCHEMA)

"""The registered queries: one lazily built pipeline per call, over whole tables.

``Pipeline`` composes the stages as DataFrame transformations from raw ad
rows (here built from the ``lineitem`` test table) to every mart and report,
so Catalyst prunes each query's plan to the columns and stages it needs.
Three things run while a query is being built: the per-campaign KPI table is
checkpointed once (it feeds statistics, medians and marts), the medians write
the counts that they rank, and the keys that name a read or write (``raw_scan``,
``raw_short_rows``, ``monitoring_scan``, ``bronze_append``, ``*_sorted``,
``stream_incremental_load``) perform it in a fresh sub-folder of the shared
work folder. Everything else runs when the caller acts on the result.

Run-time stamps (``rejected_at``, ``loaded_at``, ``last_updated``,
``detected_at``, ``run_timestamp``) are left out of the registered frames:
they differ per run by design.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.config import (
    AGE_GROUPS,
    ANOMALY_CPA_SPIKE,
    ANOMALY_CTR_DROP,
    ANOMALY_SPEND_SPIKE,
    ANOMALY_ZERO_CONVERSIONS,
    DEFAULT_CHECKPOINT,
    DEFAULT_RULES,
    GENDERS,
    RAW_COLUMNS,
    RAW_DATE_FORMAT,
    VALID_CAMPAIGN_IDS,
    Rules,
)
from adlens.operators import anomaly, dashboard, gold, ingest, reports, silver, validate
from adlens.functions.stats import grouped_medians, merged_medians, sketches
from adlens.plans import pipeline as steps
from adlens.plans.pipeline import Warehouse, sorted_tables
from adlens.session import fresh_dir, list_names, set_time, work_dir
from adlens.sources.raw import SEQ, raw_rows, read_raw_csv, scan_csv
from adlens.sources.testdata import ad_rows_from_events, ad_rows_from_lineitem, table

# the second load of the events source starts after this date
EVENTS_CHECKPOINT = "2024-01-15"


class Pipeline:
    """Every stage of the batch pipeline as a lazily built DataFrame."""

    def __init__(self, raw: DataFrame, rules: Rules = DEFAULT_RULES,
                 load_rules: str = "campaign", campaign_ids=VALID_CAMPAIGN_IDS,
                 ages=AGE_GROUPS, genders=GENDERS):
        self.raw = raw
        self.rules = rules
        self.load_rules = load_rules
        self.campaign_ids, self.ages, self.genders = campaign_ids, ages, genders

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> Pipeline:
        return cls(ad_rows_from_lineitem(spark, sf_dir), **kw)

    # validation
    @cached_property
    def checked(self) -> DataFrame:
        return validate.with_rejection_reason(self.raw, self.campaign_ids)

    # load (first load: watermark absent → every allowed row)
    @cached_property
    def new_rows(self) -> DataFrame:
        return ingest.incremental_new_rows(self.raw, DEFAULT_CHECKPOINT, self.load_rules,
                                           self.campaign_ids)

    @property
    def bronze(self) -> DataFrame:
        return self.new_rows

    # silver
    @cached_property
    def fact(self) -> DataFrame:
        return silver.fact_campaign_performance(self.bronze, self.ages, self.genders)

    @cached_property
    def dim_audience(self) -> DataFrame:
        return silver.dim_audience(self.bronze, self.ages, self.genders)

    # gold
    @cached_property
    def campaign_kpis(self) -> DataFrame:
        """M1–M6, checkpointed into the shared checkpoint folder.

        The score statistics, the medians' range sort and the marts all read
        this one-row-per-campaign table; the checkpoint cuts its lineage so
        none of them recomputes the fact from the raw rows again.
        """
        work_dir(self.raw.sparkSession)  # a checkpoint folder exists
        return gold.campaign_kpis(self.fact).checkpoint(eager=True)

    @cached_property
    def kpis(self) -> DataFrame:
        return gold.mart_from_kpis(self.campaign_kpis, self.rules)

    @cached_property
    def monitoring(self) -> DataFrame:
        return gold.campaign_monitoring(self.fact, self.rules)

    @cached_property
    def summary(self) -> DataFrame:
        return gold.campaign_summary(self.kpis)

    @cached_property
    def anomalies(self) -> DataFrame:
        return anomaly.anomaly_log(self.monitoring, self.rules)

    @cached_property
    def validation_summary(self) -> DataFrame:
        return validate.validation_summary(self.checked)

    @cached_property
    def audience(self) -> DataFrame:
        return dashboard.d01_audience_kpis(self.fact, self.dim_audience)


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    return Pipeline.from_testdata(spark, sf_dir)


def P(fn: Callable[[Pipeline], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A registered query: build one pipeline over the tables, apply ``fn``."""
    return lambda spark, sf_dir: fn(_p(spark, sf_dir))


def _raw_cols(df: DataFrame) -> DataFrame:
    return df.drop(SEQ)


def _rule_rows(which: str):
    def q(spark, d):
        return _raw_cols(_p(spark, d).checked.where(F.col("rejection_reason") == which))
    return q


def _anomaly_rule(kind: str):
    def q(spark, d):
        return anomaly.by_rule(_p(spark, d).monitoring, kind)
    return q


def _events_new_rows(spark: SparkSession, d: str) -> DataFrame:
    return ingest.incremental_new_rows(ad_rows_from_events(spark, d), EVENTS_CHECKPOINT)


def _raw_scan(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows written as header CSV, read back all-text by ``read_raw_csv``."""
    path = fresh_dir(spark, "raw-csv")
    (_raw_cols(_p(spark, d).raw).write.option("header", True).option("nullValue", "")
     .csv(path))
    return _raw_cols(read_raw_csv(spark, path))


def _raw_short_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose last two fields are missing are written without them, other missing
    values as ``NA``; read back, short rows are padded and tokens are missing again."""
    path = fresh_dir(spark, "raw-short")
    raw = _p(spark, d).raw
    whole = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("NA")) for c in RAW_COLUMNS])
    short = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("NA")) for c in RAW_COLUMNS[:-2]])
    missing = F.col(RAW_COLUMNS[-2]).isNull() & F.col(RAW_COLUMNS[-1]).isNull()
    raw.select(F.when(missing, short).otherwise(whole).alias("line")).write.text(path)
    # the written files have no header line: the reader would take the first row for it
    scanned = scan_csv(spark.read, path, header=False)
    return _raw_cols(raw_rows(scanned))


def _other_fact(spark: SparkSession, d: str) -> DataFrame:
    """T3 of a run with other campaigns, ages and genders than the default ones."""
    ids = spark.createDataFrame([("916",), ("45-49",)], "id string")
    return Pipeline.from_testdata(spark, d, campaign_ids=ids, ages=("30-34", "50-54"), genders=("F",)).fact


def _supplier_medians(spark: SparkSession, d: str) -> DataFrame:
    """M10's exact medians over a table of many groups: price and quantity by supplier."""
    return grouped_medians(table(spark, d, "lineitem"), ["l_suppkey"],
                           {"l_extendedprice": "median_price", "l_quantity": "median_quantity"})


def _sorted(which: str):
    """One of the getters over written marts, without its run time."""
    def q(spark, d):
        wh, p = Warehouse(fresh_dir(spark, "sorted-marts")), _p(spark, d)
        marts = {"kpis": ("mart_campaign_kpis", lambda: p.kpis), "summary": ("campaign_summary", lambda: p.summary),
                 "anomalies": ("anomaly_log", lambda: p.anomalies)}
        name, made = marts[which]
        wh.write(made(), name)
        return sorted_tables(spark, wh, [which])[which]
    return q


def _monitoring_scan(spark: SparkSession, d: str) -> DataFrame:
    """The daily mart written as a table, then scanned back in (campaign, date) order."""
    wh = Warehouse(fresh_dir(spark, "monitoring-scan"))
    wh.write(_p(spark, d).monitoring, "mart_campaign_monitoring")
    return wh.read(spark, "mart_campaign_monitoring").orderBy("campaign_id", "date")


def _bronze_append(spark: SparkSession, d: str) -> DataFrame:
    """The first load appended to an empty bronze; bronze read back.

    ``loaded_at`` (the run time) is left out.
    """
    wh = Warehouse(fresh_dir(spark, "bronze-append"))
    ingest.load_increment(spark, _p(spark, d).raw, wh.bronze, wh.watermark)
    return wh.read(spark, "raw_campaign_performance").drop("loaded_at")


# the first of two loads of the lineitem source ends with this date, in the middle of a month
FIRST_LOAD = "1995-06-17"


def _two_loads(spark: SparkSession, d: str, after_each) -> Warehouse:
    """All rows in two loads; ``after_each(warehouse, number)`` brings derived tables up to bronze."""
    wh, raw = Warehouse(fresh_dir(spark, "two-loads")), _p(spark, d).raw
    first = raw.where(F.to_date("reporting_start", RAW_DATE_FORMAT) <= F.lit(FIRST_LOAD).cast("date"))
    for k, rows in enumerate((first, raw)):
        ingest.load_increment(spark, rows, wh.bronze, wh.watermark)
        after_each(wh, k)
    return wh


def _fact_after_restart(spark: SparkSession, d: str) -> DataFrame:
    """The run of the first load dies before its fact; the next run makes good both loads."""
    def after(wh, k):
        if k:
            steps._write_fact(spark, wh, AGE_GROUPS, GENDERS)

    return _two_loads(spark, d, after).read(spark, "fact_campaign_performance")


def _monitoring_by_increments(spark: SparkSession, d: str) -> DataFrame:
    """The daily mart of two loads, the second going on from the frontier of the first."""
    def after(wh, k):
        steps._write_fact(spark, wh, AGE_GROUPS, GENDERS)
        steps._write_monitoring(spark, wh, DEFAULT_RULES, AGE_GROUPS, GENDERS)
        steps._write_frontier(spark, wh, DEFAULT_RULES)

    return _two_loads(spark, d, after).read(spark, "mart_campaign_monitoring")


def _kpis_by_increments(spark: SparkSession, d: str) -> DataFrame:
    """M1–M6: KPIs of two loads, merged from the fact's totals by month."""
    def after(wh, k):
        steps._write_fact(spark, wh, AGE_GROUPS, GENDERS)
        steps._write_totals(spark, wh, AGE_GROUPS, GENDERS)

    return gold.kpis_from_totals(_two_loads(spark, d, after).read(spark, "_fact_totals"))


def _dim_campaign_by_increments(spark: SparkSession, d: str) -> DataFrame:
    """The campaigns of two loads, distinct FB campaigns merged by month."""
    return _two_loads(spark, d, lambda wh, k: steps._write_dim_campaign(spark, wh)).read(spark, "dim_campaign")


def _sketched_supplier_medians(spark: SparkSession, d: str) -> DataFrame:
    """M10's approximate medians by supplier, merged from sketches by supplier and ship month."""
    columns = {"l_extendedprice": "median_price", "l_quantity": "median_quantity"}
    items = table(spark, d, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    return merged_medians(sketches(items, ["l_suppkey", "month"], list(columns)), ["l_suppkey"], columns)


# of the stream under all rules: its micro-batches, and the rows that one task sorts into a file
STREAM_BATCHES = 4
FILE_ROWS = 500_000


def _stream_all_rules(spark: SparkSession, d: str, file_rows: int = FILE_ROWS) -> DataFrame:
    """I8/V5: raw rows in files in source order, streamed in four micro-batches under all rules;
    a key's first row counts wherever the files are cut. There are four files, a micro-batch each, or as
    many more as keep a file at about ``file_rows`` rows: a task sorts one file, whatever the table's size."""
    from adlens.streaming.incremental import raw_csv_stream, stream_incremental_load

    root = fresh_dir(spark, "stream-all-rules")
    raw = _p(spark, d).raw
    files = STREAM_BATCHES * max(1, math.ceil(raw.count() / (STREAM_BATCHES * file_rows)))
    (raw.repartitionByRange(files, SEQ).sortWithinPartitions(SEQ).drop(SEQ)
     .write.option("header", True).option("nullValue", "").csv(f"{root}/incoming"))
    # the file source takes files by their time: that of the source order
    names = [n for n in list_names(spark, f"{root}/incoming") if n.startswith("part-")]
    for k, name in enumerate(names):
        set_time(spark, f"{root}/incoming/{name}", 1_700_000_000_000 + 60_000 * k)
    stream = raw_csv_stream(spark, f"{root}/incoming", math.ceil(len(names) / STREAM_BATCHES))
    stream_incremental_load(spark, stream, f"{root}/bronze", f"{root}/watermark", f"{root}/checkpoint", rules="all")
    return ingest.read_bronze(spark, f"{root}/bronze").drop("loaded_at")


def _stream_load(spark: SparkSession, d: str) -> DataFrame:
    from adlens.streaming.incremental import stream_load_testdata
    return stream_load_testdata(spark, d)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "raw_scan": _raw_scan,
    "raw_short_rows": _raw_short_rows,
    "monitoring_scan": _monitoring_scan,
    "kpis_sorted": _sorted("kpis"),
    "summary_sorted": _sorted("summary"),
    "anomalies_sorted": _sorted("anomalies"),
    # validation
    "reject_invalid_campaign": _rule_rows("invalid_campaign_id"),
    "reject_null_conversion": _rule_rows("null_conversion"),
    "reject_negative_spend": _rule_rows("negative_spend"),
    "reject_duplicates": _rule_rows("duplicate_ad_id"),
    "rejection_reason": P(lambda p: _raw_cols(p.checked)),
    "valid_rows": P(lambda p: _raw_cols(validate.valid_rows(p.checked))),
    "validation_log": P(lambda p: validate.validation_log(p.checked)),
    "validation_summary": P(lambda p: p.validation_summary),
    "rejection_breakdown": P(lambda p: validate.rejection_breakdown(p.checked)),
    # incremental load
    "parsed_dates": P(lambda p: _raw_cols(ingest.parsed_dates(p.raw))),
    "incremental_new_rows": _events_new_rows,
    "bronze_append": _bronze_append,
    "next_checkpoint": lambda s, d: ingest.next_checkpoint(_events_new_rows(s, d)),
    "stream_incremental_load": _stream_load,
    "stream_all_rules": _stream_all_rules,
    "fact_after_restart": _fact_after_restart,
    "monitoring_by_increments": _monitoring_by_increments,
    "kpis_by_increments": _kpis_by_increments,
    "dim_campaign_by_increments": _dim_campaign_by_increments,
    # silver
    "dim_campaign": P(lambda p: silver.dim_campaign(p.bronze)),
    "dim_audience": P(lambda p: p.dim_audience),
    "fact_campaign_performance": P(lambda p: p.fact),
    "fact_other_campaigns": _other_fact,
    "fact_sanity": P(lambda p: silver.fact_sanity(p.fact)),
    "fact_negative_rows": P(lambda p: silver.fact_negative_rows(p.fact)),
    # gold
    "campaign_kpis": P(lambda p: gold.campaign_kpis(p.fact)),
    "health_components": P(lambda p: gold.health_components(p.campaign_kpis)),
    "health_score": P(lambda p: gold.health_score(gold.health_components(p.campaign_kpis))),
    "kpi_medians": P(lambda p: gold.kpi_medians(p.campaign_kpis)),
    "supplier_medians": _supplier_medians,
    "supplier_medians_sketched": _sketched_supplier_medians,
    "recommendations": P(lambda p: p.kpis),
    "campaign_monitoring": P(lambda p: p.monitoring),
    "campaign_summary": P(lambda p: p.summary),
    # anomalies
    "avg_daily_spend": P(lambda p: anomaly.with_avg_daily_spend(p.monitoring)
                         .select("campaign_id", "date", "spend", "avg_daily_spend")),
    "anomaly_ctr_drop": _anomaly_rule(ANOMALY_CTR_DROP),
    "anomaly_cpa_spike": _anomaly_rule(ANOMALY_CPA_SPIKE),
    "anomaly_spend_spike": _anomaly_rule(ANOMALY_SPEND_SPIKE),
    "anomaly_zero_conversions": _anomaly_rule(ANOMALY_ZERO_CONVERSIONS),
    "anomaly_log": P(lambda p: p.anomalies),
    "anomaly_counts": P(lambda p: anomaly.anomaly_counts(p.anomalies)),
    "anomaly_sample": P(lambda p: anomaly.anomaly_sample(p.monitoring)),
    # named queries
    "q01_kpi_overview": P(lambda p: reports.q01_kpi_overview(p.kpis)),
    "q02_top_conversions": P(lambda p: reports.q02_top_conversions(p.kpis)),
    "q03_lowest_cpa": P(lambda p: reports.q03_lowest_cpa(p.kpis)),
    "q04_highest_ctr": P(lambda p: reports.q04_highest_ctr(p.kpis)),
    "q05_budget_efficiency": P(lambda p: reports.q05_budget_efficiency(p.kpis)),
    "q06_age_performance": P(lambda p: reports.q06_age_performance(p.fact, p.dim_audience)),
    "q07_age_gender": P(lambda p: reports.q07_age_gender(p.fact, p.dim_audience)),
    "q08_daily_trend": P(lambda p: reports.q08_daily_trend(p.monitoring)),
    "q09_health_ranking": P(lambda p: reports.q09_health_ranking(p.summary, p.kpis)),
    "q10_anomaly_report": P(lambda p: reports.q10_anomaly_report(p.anomalies)),
    "q11_data_quality": P(lambda p: reports.q11_data_quality(p.validation_summary)),
    "q12_ctr_change": P(lambda p: reports.q12_ctr_change(p.monitoring)),
    "q13_concentration_risk": P(lambda p: reports.q13_concentration_risk(p.kpis)),
    # dashboard datasets
    "d01_audience_kpis": P(lambda p: p.audience),
    "d02_blended_kpis": P(lambda p: dashboard.d02_blended_kpis(p.kpis)),
    "d03_score_components_long": P(lambda p: dashboard.d03_score_components_long(p.kpis)),
    "d04_audience_labels": P(lambda p: dashboard.d04_audience_labels(p.audience)),
    "d05_best_audiences": P(lambda p: dashboard.d05_best_audiences(p.audience)),
    "d06_age_rollup": P(lambda p: dashboard.d06_age_rollup(p.audience)),
    "d07_gender_rollup": P(lambda p: dashboard.d07_gender_rollup(p.audience)),
    "d08_ctr_pivot": P(lambda p: dashboard.d08_ctr_pivot(p.audience)),
    "d09_efficiency_quadrant": P(lambda p: dashboard.d09_efficiency_quadrant(p.kpis)),
    "d10_budget_verdict": P(lambda p: dashboard.d10_budget_verdict(p.kpis)),
    "d11_rejection_reasons": P(lambda p: dashboard.d11_rejection_reasons(p.validation_summary)),
    "d12_severity_totals": P(lambda p: dashboard.d12_severity_totals(p.anomalies)),
    "d14_health_ascending": P(lambda p: dashboard.d14_health_ascending(p.kpis)),
    "d14_cpa_descending": P(lambda p: dashboard.d14_cpa_descending(p.kpis)),
    "d16_daily_series": P(lambda p: dashboard.d16_series(p.monitoring)),
}

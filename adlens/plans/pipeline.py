"""The five stages run end to end over written tables.

validate → load → silver → gold → anomalies, then the reports read the
written marts. Every table is versioned (``adlens.versions``): a step writes new
folders and one commit makes them the table, so readers see a table whole, before or
after, and a step that dies leaves it as it was.

Each table derived from bronze notes, in the commit of its data, up to which load
(``through``) it holds bronze. What a run has to do follows from these notes and not from
the watermark: the months that bronze got since then. A run that died between any two
steps is therefore made good by the next one, and a first load is the case that
nothing is held yet. Other settings or a bronze begun anew make a table whole again.

* validation: two narrow reads (key columns, then key and source order of
  rows that may have a duplicated key) and a read of the other rows beside one of
  these, which write ``validation_log``; the counts of the summary are observed on
  that write (``Observation``), so the checked rows are neither cached nor read again.
* load: one pass over the raw source (rule 1, dates, watermark) into bronze. It
  starts when validation has succeeded: a failed validation leaves bronze and
  watermark as they were.
* silver, by month: the fact and the FB campaigns of each campaign, of the months that
  bronze got; ``_fact_totals`` are the fact's sums by month, campaign and audience,
  from which the KPIs, ``dim_audience`` and the checks (T4, T5) are merged.
* gold: the daily mart by month; each campaign's last rows ahead of the mart's last month
  are kept (``_daily_frontier``), so that an increment computes rolling means from there
  on. What has no new input is not made again.

Steps without a dependency between them run as concurrent Spark jobs
(``run_pipeline``), so the cluster is not idle while one step finishes its
last tasks.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlens.config import (
    AGE_GROUPS,
    DEFAULT_RULES,
    GENDERS,
    REASON_DUPLICATE,
    REASON_INVALID_CAMPAIGN,
    REASON_NEGATIVE_SPEND,
    REASON_NULL_CONVERSION,
    VALID_CAMPAIGN_IDS,
    Rules,
)
from adlens.functions import round_half_away_value
from adlens.operators import anomaly, gold, ingest, silver, validate
from adlens.session import fresh_dir
from adlens.versions import MONTH, Commit, VersionedTable

TABLES = ("validation_log", "validation_summary", "dim_campaign", "dim_audience",
          "fact_campaign_performance", "mart_campaign_kpis", "mart_campaign_monitoring",
          "campaign_summary", "anomaly_log")
MONITORING = "mart_campaign_monitoring"
# what increments are merged from
STATES = ("_campaign_ads", "_fact_totals", "_campaign_kpis", "_daily_frontier")


@dataclass
class Warehouse:
    """Versioned Parquet tables under one root folder on shared storage."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, spark: SparkSession, name: str) -> VersionedTable:
        return VersionedTable(spark, self.path(name))

    def write(self, df: DataFrame, name: str, state: dict | None = None) -> Commit:
        """The table anew, as its next version."""
        return self.table(df.sparkSession, name).replace(df, state)

    def read(self, spark: SparkSession, name: str, months=None) -> DataFrame:
        """The table's last version; of some months only, if given, where it is kept by month."""
        if name == "raw_campaign_performance":
            return self.table(spark, name).read(months=months, schema=ingest.BRONZE_SCHEMA)
        found = self.table(spark, name).read(months=months)
        return found.drop(*gold.RAW_RATIOS, MONTH) if name == MONITORING else found

    def versions(self, spark: SparkSession, names) -> dict[str, int]:
        return {n: self.table(spark, n).current().version for n in names}

    def vacuum(self, spark: SparkSession, keep: int = 10) -> int:
        """Remove the data of versions before the last ``keep`` of every table; not while a run is writing."""
        return sum(self.table(spark, n).vacuum(keep) for n in (*TABLES, *STATES, "raw_campaign_performance"))

    def register_views(self, spark: SparkSession) -> list[str]:
        """Every written table as a temporary view of the same name, for SQL."""
        names = list(TABLES) + ["raw_campaign_performance"]
        for name in names:
            self.read(spark, name).createOrReplaceTempView(name)
        return names

    @property
    def bronze(self) -> str:
        return self.path("raw_campaign_performance")

    @property
    def watermark(self) -> str:
        return self.path("_checkpoint_last_loaded_date")


@dataclass
class RunReport:
    timings: dict = field(default_factory=dict)
    validation: dict = field(default_factory=dict)
    load: dict = field(default_factory=dict)
    checks: dict = field(default_factory=dict)


def run_validation(spark: SparkSession, raw: DataFrame, wh: Warehouse,
                   run_ts: dt.datetime, campaign_ids=VALID_CAMPAIGN_IDS) -> dict:
    """Stage 1: ``validation_log`` and ``validation_summary`` in one pass."""
    obs = Observation()  # unique name: concurrent runs do not collide
    r = F.col(validate.REASON)
    checked = validate.with_rejection_reason(raw, campaign_ids).observe(
        obs,
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(r.isNull()).alias("valid_rows"),
        F.count_if(r == REASON_INVALID_CAMPAIGN).alias("reason_invalid_campaign"),
        F.count_if(r == REASON_NULL_CONVERSION).alias("reason_null_conversion"),
        F.count_if(r == REASON_NEGATIVE_SPEND).alias("reason_negative_spend"),
        F.count_if(r == REASON_DUPLICATE).alias("reason_duplicate"),
    )
    wh.write(validate.validation_log(checked, run_ts), "validation_log")
    m = obs.get
    total, valid = int(m["total_rows"]), int(m["valid_rows"])
    rejected = total - valid
    pct = round_half_away_value(rejected / total * 100, 2) if total else 0.0
    row = (run_ts, total, valid, rejected, float(pct), int(m["reason_invalid_campaign"]),
           int(m["reason_null_conversion"]), int(m["reason_negative_spend"]),
           int(m["reason_duplicate"]))
    summary = spark.createDataFrame([row], (
        "run_timestamp timestamp, total_rows long, valid_rows long, rejected_rows long, "
        "pct_rejected double, reason_invalid_campaign long, reason_null_conversion long, "
        "reason_negative_spend long, reason_duplicate long"))
    wh.write(summary.coalesce(1), "validation_summary")
    return dict(zip(summary.columns, row))


# -- derived tables: what they lack of bronze -------------------------------------------------

def _lacking(bronze: Commit, held: Commit, config: list) -> list[str] | None:
    """The months that bronze got since ``held`` was made; None: all (nothing held, other settings or another bronze)."""
    s = held.state
    if held.version == 0 or s.get("lineage") != bronze.state.get("lineage") or s.get("config") != config:
        return None
    return bronze.months(after_seq=s["through"])


def _state(bronze: Commit, config: list) -> dict:
    return {"lineage": bronze.state.get("lineage"), "through": bronze.state.get("seq", 0), "config": config}


def _put_months(table: VersionedTable, held: Commit, months: list[str] | None, rows: DataFrame, state: dict) -> None:
    """``rows`` (with their month) in place of what the table holds of ``months``, all of it for None; a folder a month."""
    new = table.write(rows.hint("rebalance", MONTH), by_month=True)
    kept = [] if months is None else [f for f in held.folders if f.month not in set(months)]
    table.commit(held, [*kept, *new], rows.drop(MONTH).schema, state)


def _put_small(table: VersionedTable, held: Commit, months: list[str] | None, rows: DataFrame, bronze: Commit, state: dict) -> None:
    """The same for a table that is small for its months: one folder, its rows by month."""
    by_month = rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH)
    table.replace_months(held, months, by_month, bronze.months(), state)


def _update_months(spark: SparkSession, wh: Warehouse, name: str, config: list, rows_of, small: bool = True) -> None:
    """Bring a table kept by month up to bronze; ``rows_of(months)`` gives the rows of months (None: all)."""
    bronze, table = wh.table(spark, "raw_campaign_performance").current(), wh.table(spark, name)
    held = table.current()
    months = _lacking(bronze, held, config)
    if months == []:
        return
    if small:
        _put_small(table, held, months, rows_of(months), bronze, _state(bronze, config))
    else:
        _put_months(table, held, months, rows_of(months), _state(bronze, config))


def _update_whole(spark: SparkSession, wh: Warehouse, name: str, inputs: list[str], config: list, rows) -> None:
    """Make a whole table anew where a table that it is made of, or a setting, has changed."""
    state = {"inputs": wh.versions(spark, inputs), "config": config}
    if wh.table(spark, name).current().state != state:
        wh.write(rows(), name, state)


def _settings(rules: Rules) -> list:
    return [repr(rules)]


def _write_fact(spark: SparkSession, wh: Warehouse, ages, genders) -> None:
    """T3 of the months that the fact lacks."""
    def rows(months):
        fact = silver.fact_campaign_performance(wh.read(spark, "raw_campaign_performance", months), ages, genders)
        return fact.withColumn(MONTH, ingest.month_of("date"))

    _update_months(spark, wh, "fact_campaign_performance", [list(ages), list(genders)], rows, small=False)


def _write_dim_campaign(spark: SparkSession, wh: Warehouse) -> None:
    """The FB campaigns of the months that bronze got, merged with those of the others."""
    _update_months(spark, wh, "_campaign_ads", [], lambda months: silver.campaign_ads(
        wh.read(spark, "raw_campaign_performance", months)))
    _update_whole(spark, wh, "dim_campaign", ["_campaign_ads"], [], lambda: silver.dim_campaign_from(
        wh.read(spark, "_campaign_ads")))


def _write_totals(spark: SparkSession, wh: Warehouse, ages, genders) -> None:
    """The fact's sums, of the months that these lack."""
    _update_months(spark, wh, "_fact_totals", [list(ages), list(genders)], lambda months: silver.fact_totals(
        wh.read(spark, "fact_campaign_performance", months)))


def _write_dim_audience(spark: SparkSession, wh: Warehouse) -> None:
    _update_whole(spark, wh, "dim_audience", ["_fact_totals"], [], lambda: silver.dim_audience_from(
        wh.read(spark, "_fact_totals")))


def _check_fact(spark: SparkSession, wh: Warehouse) -> dict:
    """T4 and T5 over the fact, from its totals and the dates of the daily mart."""
    dates = wh.read(spark, MONITORING).select("date").distinct().count()
    return silver.sanity_from(wh.read(spark, "_fact_totals"), dates).first().asDict()


def _write_campaign_kpis(spark: SparkSession, wh: Warehouse) -> None:
    _update_whole(spark, wh, "_campaign_kpis", ["_fact_totals"], [], lambda: gold.kpis_from_totals(
        wh.read(spark, "_fact_totals")))


def _write_monitoring(spark: SparkSession, wh: Warehouse, rules: Rules, ages, genders) -> None:
    """M13–M15 from the first month on that the mart lacks; rolling means go on from the frontier.

    The frontier holds each campaign's last rows ahead of the mart's last month. Loads
    bring later dates only, so they begin in that month or behind it; where one does
    not (bronze was changed otherwise), the mart is made whole again.
    """
    config = [*_settings(rules), list(ages), list(genders)]
    bronze, table = wh.table(spark, "raw_campaign_performance").current(), wh.table(spark, MONITORING)
    held, frontier = table.current(), wh.table(spark, "_daily_frontier").current()
    months = _lacking(bronze, held, config)
    if months == []:
        return
    fact_months, ahead = wh.table(spark, "fact_campaign_performance").current().months(), None
    if months is not None and held.folders:
        last = held.months()[-1]
        # a frontier is as good as the mart's rows that it was made of
        if min(months) >= last and frontier.state == {"before": last, "mart": held.state.get("frontier")}:
            months, ahead = [m for m in fact_months if m >= last], wh.read(spark, "_daily_frontier")
        else:
            months = None
    elif months is not None:
        months = None
    daily = gold.daily_rows(wh.read(spark, "fact_campaign_performance", months))
    rows = gold.rolling(daily, rules, ahead).withColumn(MONTH, ingest.month_of("date"))
    mark = held.state.get("frontier") if ahead is not None else f"{held.version + 1}"
    _put_small(table, held, months, rows, bronze, {**_state(bronze, config), "frontier": mark})


def _write_frontier(spark: SparkSession, wh: Warehouse, rules: Rules) -> None:
    """Each campaign's last rows ahead of the mart's last month, from the months behind the frontier before."""
    mart, table = wh.table(spark, MONITORING), wh.table(spark, "_daily_frontier")
    made, held = mart.current(), table.current()
    if not made.folders:
        return
    last, mark = made.months()[-1], made.state["frontier"]
    if held.state == {"before": last, "mart": mark}:
        return
    goes_on = held.state.get("mart") == mark
    since = held.state["before"] if goes_on else ""
    some = mart.read(made, [m for m in made.months() if since <= m < last])
    table.replace(gold.last_rows(some, table.read(held) if goes_on else None, rules), {"before": last, "mart": mark})


def _write_kpi_mart(spark: SparkSession, wh: Warehouse, rules: Rules,
                    run_ts: dt.datetime, approximate: bool = False) -> None:
    """The KPI mart from the written per-campaign KPIs, which its statistics read as well."""
    _update_whole(spark, wh, "mart_campaign_kpis", ["_campaign_kpis"], [*_settings(rules), approximate],
                  lambda: gold.mart_from_kpis(wh.read(spark, "_campaign_kpis"), rules, run_ts, approximate))


def _write_summary(spark: SparkSession, wh: Warehouse) -> None:
    _update_whole(spark, wh, "campaign_summary", ["mart_campaign_kpis"], [], lambda: gold.campaign_summary(
        wh.read(spark, "mart_campaign_kpis")))


def _write_anomalies(spark: SparkSession, wh: Warehouse, rules: Rules,
                     run_ts: dt.datetime) -> None:
    """A1–A10 over the whole daily mart: a new day moves the campaign's mean, against which all days are judged."""
    _update_whole(spark, wh, "anomaly_log", [MONITORING], _settings(rules), lambda: anomaly.anomaly_log(
        wh.read(spark, MONITORING), rules, run_ts))


def _concurrently(rep: RunReport, steps: dict) -> dict:
    """Run independent steps as concurrent Spark jobs; wait for all of them.

    Spark schedules the jobs of several threads together, so one step's
    tasks fill the cores another step's last tasks leave idle. Each step's
    own wall time is recorded; the first failure is raised.
    """
    results = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        rep.timings[name] = round(time.perf_counter() - t, 3)
        return out

    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = {name: pool.submit(timed, name, fn) for name, fn in steps.items()}
        for name, fut in futures.items():
            results[name] = fut.result()
    return results


def run_pipeline(spark: SparkSession, raw: DataFrame, warehouse: str | None = None,
                 rules: Rules = DEFAULT_RULES, load_rules: str = "campaign",
                 run_ts: dt.datetime | None = None, campaign_ids=VALID_CAMPAIGN_IDS,
                 ages=AGE_GROUPS, genders=GENDERS, approximate_medians: bool = False) -> tuple[Warehouse, RunReport]:
    """All five stages; returns the warehouse and per-step timings.

    ``campaign_ids`` (ids, or a table of them), ``ages`` and ``genders`` are
    what the run allows; ``approximate_medians`` takes M10 from sketches. Steps that
    read the same inputs and write different tables run as concurrent jobs, each as
    soon as what it needs is there:

    1. validation (raw → log, summary)
    2. load (raw → bronze)
    3. ``dim_campaign`` (bronze)  ‖  fact (bronze), and after the fact
       its totals → (KPIs → KPI mart → summary  ‖  ``dim_audience``)
       ‖  daily mart → (anomaly log  ‖  frontier  ‖  checks of the fact, once the totals are there)
    """
    wh = Warehouse(warehouse or fresh_dir(spark, "warehouse"))
    run_ts = run_ts or dt.datetime.now()
    rep = RunReport()
    t0 = time.perf_counter()
    rep.validation = _concurrently(rep, {
        "validate": lambda: run_validation(spark, raw, wh, run_ts, campaign_ids)})["validate"]
    rep.load = _concurrently(rep, {
        "ingest": lambda: ingest.load_increment(spark, raw, wh.bronze, wh.watermark,
                                                run_ts, load_rules, campaign_ids)})["ingest"]
    build_marts(spark, wh, rep, rules, run_ts, ages, genders, approximate_medians)
    rep.timings["total"] = round(time.perf_counter() - t0, 3)
    return wh, rep


def build_marts(spark: SparkSession, wh: Warehouse, rep: RunReport, rules: Rules, run_ts: dt.datetime,
                ages, genders, approximate_medians: bool = False) -> None:
    """Bring everything derived from bronze up to it (step 3 of ``run_pipeline``)."""
    totals_done = threading.Event()

    def from_totals():
        try:
            _concurrently(rep, {"totals": lambda: _write_totals(spark, wh, ages, genders)})
        finally:
            totals_done.set()
        _concurrently(rep, {"kpis": kpis, "dim_audience": lambda: _write_dim_audience(spark, wh)})

    def kpis():
        _concurrently(rep, {"campaign_kpis": lambda: _write_campaign_kpis(spark, wh)})
        _concurrently(rep, {"kpi_mart": lambda: _write_kpi_mart(spark, wh, rules, run_ts, approximate_medians)})
        _concurrently(rep, {"summary": lambda: _write_summary(spark, wh)})

    def from_days():
        _concurrently(rep, {"monitoring": lambda: _write_monitoring(spark, wh, rules, ages, genders)})
        rep.checks = _concurrently(rep, {"anomaly": lambda: _write_anomalies(spark, wh, rules, run_ts),
                                         "frontier": lambda: _write_frontier(spark, wh, rules),
                                         "checks": checks})["checks"]

    def checks():
        totals_done.wait()
        return _check_fact(spark, wh)

    def from_fact():
        _concurrently(rep, {"fact": lambda: _write_fact(spark, wh, ages, genders)})
        _concurrently(rep, {"from_totals": from_totals, "from_days": from_days})

    _concurrently(rep, {"dim_campaign": lambda: _write_dim_campaign(spark, wh), "from_fact": from_fact})
    for name in ("from_fact", "from_totals", "from_days", "kpis"):  # each is the sum of steps that are listed
        rep.timings.pop(name, None)


# The written marts and the order in which each is shown (``-``: falling)
SHOWN = {
    "kpis": ("mart_campaign_kpis", ["campaign_id"]),
    "monitoring": ("mart_campaign_monitoring", ["campaign_id", "date"]),
    "summary": ("campaign_summary", ["-health_score", "campaign_id"]),
    "anomalies": ("anomaly_log", ["severity", "date", "campaign_id", "anomaly_type"]),
    "validation": ("validation_summary", []),
}


def sorted_tables(spark: SparkSession, wh: Warehouse, names=tuple(SHOWN)) -> dict[str, DataFrame]:
    """The written marts in the order in which they are shown."""
    out = {}
    for name in names:
        mart, order = SHOWN[name]
        keys = [F.desc_nulls_last(k[1:]) if k[0] == "-" else F.col(k) for k in order]
        out[name] = wh.read(spark, mart).orderBy(*keys) if keys else wh.read(spark, mart)
    return out


def audience_table(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The audience KPIs, computed once for the datasets that share them: written and read back."""
    from adlens.operators import dashboard as d
    path = fresh_dir(spark, "audience-kpis")
    d.d01_audience_kpis(wh.read(spark, "fact_campaign_performance"),
                        wh.read(spark, "dim_audience")).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


# Tables that each named query reads
REPORT_INPUTS = {
    **dict.fromkeys(("q01_kpi_overview", "q02_top_conversions", "q03_lowest_cpa", "q04_highest_ctr", "q05_budget_efficiency",
                     "q13_concentration_risk"), ("mart_campaign_kpis",)),
    **dict.fromkeys(("q06_age_performance", "q07_age_gender"), ("fact_campaign_performance", "dim_audience")),
    **dict.fromkeys(("q08_daily_trend", "q12_ctr_change"), (MONITORING,)),
    "q09_health_ranking": ("campaign_summary", "mart_campaign_kpis"),
    "q10_anomaly_report": ("anomaly_log",),
    "q11_data_quality": ("validation_summary",),
}


def kept_result(spark: SparkSession, wh: Warehouse, name: str, inputs, build) -> DataFrame:
    """The result of a query, made once for the versions of the tables that it reads.

    The result is a versioned table beside the marts, its rows with their place in the
    query's order. While ``inputs`` have the same versions it is read back, by this or any
    other session, and no Spark job runs for it before its rows are asked for; a new
    version of one of them makes it anew.
    """
    table = wh.table(spark, f"_results/{name}")
    state = {"inputs": wh.versions(spark, inputs)}
    held = table.current()
    if held.state != state:
        held = table.replace(build().withColumn("_place", F.monotonically_increasing_id()), state)
        table.vacuum()
    return table.read(held).orderBy("_place").drop("_place")


def kept_reports(spark: SparkSession, wh: Warehouse, names=tuple(REPORT_INPUTS)) -> dict[str, DataFrame]:
    """The named queries, each kept for the versions of what it reads."""
    made = {}

    def build(name):
        if not made:
            made.update(warehouse_reports(spark, wh))
        return made[name]

    return {n: kept_result(spark, wh, n, REPORT_INPUTS[n], lambda n=n: build(n)) for n in names}


def warehouse_reports(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    """The 13 named queries over the written marts."""
    from adlens.operators import reports as q
    kpis = wh.read(spark, "mart_campaign_kpis")
    summary = wh.read(spark, "campaign_summary")
    mon = wh.read(spark, "mart_campaign_monitoring")
    log = wh.read(spark, "anomaly_log")
    fact = wh.read(spark, "fact_campaign_performance")
    dim = wh.read(spark, "dim_audience")
    vsum = wh.read(spark, "validation_summary")
    return {
        "q01_kpi_overview": q.q01_kpi_overview(kpis),
        "q02_top_conversions": q.q02_top_conversions(kpis),
        "q03_lowest_cpa": q.q03_lowest_cpa(kpis),
        "q04_highest_ctr": q.q04_highest_ctr(kpis),
        "q05_budget_efficiency": q.q05_budget_efficiency(kpis),
        "q06_age_performance": q.q06_age_performance(fact, dim),
        "q07_age_gender": q.q07_age_gender(fact, dim),
        "q08_daily_trend": q.q08_daily_trend(mon),
        "q09_health_ranking": q.q09_health_ranking(summary, kpis),
        "q10_anomaly_report": q.q10_anomaly_report(log),
        "q11_data_quality": q.q11_data_quality(vsum),
        "q12_ctr_change": q.q12_ctr_change(mon),
        "q13_concentration_risk": q.q13_concentration_risk(kpis),
    }


def warehouse_dashboard(spark: SparkSession, wh: Warehouse) -> dict[str, DataFrame]:
    """The dashboard datasets (D1–D16) over the written marts."""
    from adlens.operators import dashboard as d
    kpis = wh.read(spark, "mart_campaign_kpis")
    mon = wh.read(spark, "mart_campaign_monitoring")
    log = wh.read(spark, "anomaly_log")
    audience = audience_table(spark, wh)
    return {
        "d01_audience_kpis": audience,
        "d02_blended_kpis": d.d02_blended_kpis(kpis),
        "d03_score_components_long": d.d03_score_components_long(kpis),
        "d04_audience_labels": d.d04_audience_labels(audience),
        "d05_best_audiences": d.d05_best_audiences(audience),
        "d06_age_rollup": d.d06_age_rollup(audience),
        "d07_gender_rollup": d.d07_gender_rollup(audience),
        "d08_ctr_pivot": d.d08_ctr_pivot(audience),
        "d09_efficiency_quadrant": d.d09_efficiency_quadrant(kpis),
        "d10_budget_verdict": d.d10_budget_verdict(kpis),
        "d11_rejection_reasons": d.d11_rejection_reasons(wh.read(spark, "validation_summary")),
        "d12_severity_totals": d.d12_severity_totals(log),
        "anomaly_counts": anomaly.anomaly_counts(log),
        "d14_health_ascending": d.d14_health_ascending(kpis),
        "d14_cpa_descending": d.d14_cpa_descending(kpis),
        "d16_daily_series": d.d16_series(mon),
    }

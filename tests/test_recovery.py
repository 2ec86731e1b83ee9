"""A run that dies anywhere is made good by the next one; increments do only what is new."""

import datetime as dt
import threading

import pytest

from adlens.config import AGE_GROUPS, GENDERS
from adlens.operators import ingest
from adlens.plans import pipeline
from adlens.plans.pipeline import MONITORING, REPORT_INPUTS, STATES, TABLES, kept_reports, run_pipeline, warehouse_reports
from adlens.session import fresh_dir
from adlens.versions import VersionedTable
from tests.test_ingest import rows_for
from tests.test_validate import ok, raw_frame

TS = dt.datetime(2024, 1, 1)
DAYS = ["17/07/2017", "18/07/2017", "30/07/2017", "17/08/2017", "18/08/2017", "19/08/2017", "02/09/2017", "05/10/2017"]
DERIVED = ("dim_campaign", "dim_audience", "fact_campaign_performance", "mart_campaign_kpis", "mart_campaign_monitoring",
           "campaign_summary", "anomaly_log", "_fact_totals", "_campaign_ads")
STAMPS = ("last_updated", "detected_at", "run_timestamp", "rejected_at", "loaded_at")


def source(spark, n):
    rows = []
    for k, campaign in enumerate(("916", "936", "1178")):
        rows += [ok(**{**r, "ad_id": f"{k}{r['ad_id']}", "spent": f"{1.5 + 7 * i + k}", "clicks": str(3 + i * k),
                       "fb_campaign_id": str(100 + (i * k) % 4), "approved_conversion": str((i + k) % 3)})
                 for i, r in enumerate(rows_for(DAYS[:n], campaign))]
    return raw_frame(spark, rows)


def tables(spark, wh):
    return {t: sorted((tuple(r) for r in wh.read(spark, t).drop(*STAMPS).collect()), key=str) for t in DERIVED}


@pytest.fixture(scope="module")
def whole(spark):
    """All days by one run, and by one run for the first five."""
    return {n: tables(spark, run_pipeline(spark, source(spark, n), run_ts=TS)[0]) for n in (5, len(DAYS))}


class Dies:
    """Lets so many commits through and fails every later one."""

    def __init__(self, commits):
        self.left, self.lock = commits, threading.Lock()
        self.commit = VersionedTable.commit

    def __call__(self, table, *args, **kw):
        with self.lock:
            self.left -= 1
            if self.left < 0:
                raise RuntimeError("dead")
        return self.commit(table, *args, **kw)


def dies_after(spark, monkeypatch, wh, raw, commits):
    dies = Dies(commits)
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", lambda self, *a, **k: dies(self, *a, **k))
        with pytest.raises(RuntimeError, match="dead"):
            run_pipeline(spark, raw, wh, run_ts=TS)


@pytest.mark.parametrize("commits", [1, 3, 4, 6, 9])  # log, bronze, watermark, then silver and gold
def test_a_first_load_that_dies(spark, monkeypatch, whole, commits):
    root = fresh_dir(spark, "t-dies")
    dies_after(spark, monkeypatch, root, source(spark, len(DAYS)), commits)
    wh, rep = run_pipeline(spark, source(spark, len(DAYS)), root, run_ts=TS)
    assert tables(spark, wh) == whole[len(DAYS)]
    assert rep.checks["total_rows"] == 3 * len(DAYS) and rep.checks["dates"] == len(DAYS)


@pytest.mark.parametrize("commits", [3, 5, 7, 10])
def test_an_increment_that_dies(spark, monkeypatch, whole, commits):
    root = fresh_dir(spark, "t-dies-later")
    wh, _ = run_pipeline(spark, source(spark, 5), root, run_ts=TS)
    assert tables(spark, wh) == whole[5]
    dies_after(spark, monkeypatch, root, source(spark, len(DAYS)), commits)
    wh, _ = run_pipeline(spark, source(spark, len(DAYS)), root, run_ts=TS)
    assert tables(spark, wh) == whole[len(DAYS)]


def test_day_by_day_equals_one_run(spark, whole):
    """Rolling means go on from the frontier, through months without a row and inside a month."""
    root = fresh_dir(spark, "t-days")
    for n in (1, 2, 4, 5, 7, 8):
        wh, rep = run_pipeline(spark, source(spark, n), root, run_ts=TS)
        assert rep.checks["dates"] == n
    assert tables(spark, wh) == whole[len(DAYS)]


def test_an_increment_reads_and_writes_its_months_only(spark, monkeypatch):
    root = fresh_dir(spark, "t-months-only")
    wh, _ = run_pipeline(spark, source(spark, 6), root, run_ts=TS)
    before = {t: wh.table(spark, t).current().folders for t in ("fact_campaign_performance", MONITORING, "_fact_totals")}
    asked = []
    read = pipeline.Warehouse.read
    monkeypatch.setattr(pipeline.Warehouse, "read", lambda self, s, name, months=None: (
        asked.append((name, months)), read(self, s, name, months))[1])
    wh, _ = run_pipeline(spark, source(spark, len(DAYS)), root, run_ts=TS)
    assert ("raw_campaign_performance", ["2017-09", "2017-10"]) in asked
    assert not [m for name, m in asked if name in ("raw_campaign_performance", "fact_campaign_performance")
                and (m is None or "2017-07" in m)]
    for t, folders in before.items():  # the old months' folders are untouched
        now = {f.path for f in wh.table(spark, t).current().folders}
        old = {f.path for f in folders if f.month == "2017-07" or "2017-07" in f.live}
        assert old and old <= now


def test_what_has_no_new_input_is_not_made_again(spark):
    root = fresh_dir(spark, "t-again")
    wh, _ = run_pipeline(spark, source(spark, 4), root, run_ts=TS)
    before = wh.versions(spark, [*DERIVED, *STATES])
    run_pipeline(spark, source(spark, 4), root, run_ts=TS)
    assert wh.versions(spark, [*DERIVED, *STATES]) == before


def test_other_settings_and_a_reset_make_tables_whole(spark):
    root = fresh_dir(spark, "t-settings")
    wh, _ = run_pipeline(spark, source(spark, 4), root, run_ts=TS)
    wh, _ = run_pipeline(spark, source(spark, 5), root, run_ts=TS, ages=("30-34",), genders=("F",))
    assert wh.read(spark, "fact_campaign_performance").count() == 0  # all rows are of another audience
    run_pipeline(spark, source(spark, 5), root, run_ts=TS, ages=AGE_GROUPS, genders=GENDERS)
    ingest.reset_load(spark, wh.bronze, wh.watermark)
    wh, rep = run_pipeline(spark, source(spark, 2), root, run_ts=TS)
    alone, _ = run_pipeline(spark, source(spark, 2), run_ts=TS)
    assert rep.load["inserted"] == 6 and tables(spark, wh) == tables(spark, alone)


def test_a_reader_and_a_writer_at_once(spark):
    """A frame opened before an increment shows the tables as they were; vacuum keeps the last versions."""
    root = fresh_dir(spark, "t-reader")
    wh, _ = run_pipeline(spark, source(spark, 4), root, run_ts=TS)
    fact, kpis = wh.read(spark, "fact_campaign_performance"), wh.read(spark, "mart_campaign_kpis")
    run_pipeline(spark, source(spark, 8), root, run_ts=TS)
    assert fact.count() == 12 and kpis.agg({"fact_rows": "sum"}).first()[0] == 12
    assert wh.read(spark, "fact_campaign_performance").count() == 24
    assert wh.vacuum(spark, keep=1) > 0 and wh.read(spark, "mart_campaign_kpis").agg({"fact_rows": "sum"}).first()[0] == 24
    assert set(TABLES) <= set(wh.register_views(spark))


def jobs_of(spark, fn):
    sc = spark.sparkContext
    group = f"t-{id(fn)}"
    sc.setJobGroup(group, group)
    try:
        fn()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_kept_results(spark):
    root = fresh_dir(spark, "t-kept")
    wh, _ = run_pipeline(spark, source(spark, 4), root, run_ts=TS)
    fresh = {n: df.collect() for n, df in warehouse_reports(spark, wh).items()}
    first = kept_reports(spark, wh)
    assert set(first) == set(REPORT_INPUTS) == set(fresh)
    for name, df in first.items():
        assert df.collect() == fresh[name], name  # the query's order too
    assert jobs_of(spark, lambda: kept_reports(spark, wh)) == 0
    run_pipeline(spark, source(spark, 8), root, run_ts=TS)
    assert jobs_of(spark, lambda: kept_reports(spark, wh, ["q08_daily_trend"])) > 0
    assert jobs_of(spark, lambda: kept_reports(spark, wh, ["q08_daily_trend"])) == 0
    now = kept_reports(spark, wh, ["q08_daily_trend"])["q08_daily_trend"]
    assert now.collect() == warehouse_reports(spark, wh)["q08_daily_trend"].collect()

"""Incremental load: watermark, strict date filter, empty batch, replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlens.operators import ingest
from adlens.session import fresh_dir
from adlens.versions import VersionedTable
from tests.test_validate import ok, raw_frame

TS = dt.datetime(2024, 1, 1, 12, 0, 0)


def rows_for(days, campaign="916"):
    return [ok(ad_id=str(i), reporting_start=d, reporting_end=d, campaign_id=campaign)
            for i, d in enumerate(days)]


def test_checkpoint_defaults_and_roundtrip(spark):
    root = fresh_dir(spark, "t-ck")
    assert ingest.read_checkpoint(spark, f"{root}/none") == dt.date(1900, 1, 1)
    ingest.write_checkpoint(spark, f"{root}/ck", dt.date(2017, 8, 20))
    assert ingest.read_checkpoint(spark, f"{root}/ck") == dt.date(2017, 8, 20)


def test_unparsable_checkpoint_falls_back(spark):
    root = fresh_dir(spark, "t-ck2")
    table = VersionedTable(spark, f"{root}/ck")
    table.commit(table.current(), [], state={"last_loaded_date": "garbage"})
    assert ingest.read_checkpoint(spark, f"{root}/ck") == dt.date(1900, 1, 1)


def test_two_step_load_and_rerun(spark):
    root = fresh_dir(spark, "t-load")
    bronze, ck = f"{root}/bronze", f"{root}/ck"
    first = raw_frame(spark, rows_for(["17/08/2017", "18/08/2017"]) + [
        ok(ad_id="x", campaign_id="45-49")])
    r1 = ingest.load_increment(spark, first, bronze, ck, TS)
    assert r1["inserted"] == 2 and r1["new_checkpoint"] == dt.date(2017, 8, 18)
    # the source grows: one late row (at the checkpoint date) and two new days
    second = raw_frame(spark, rows_for(["17/08/2017", "18/08/2017", "18/08/2017",
                                        "19/08/2017", "20/08/2017"]))
    r2 = ingest.load_increment(spark, second, bronze, ck, TS)
    assert r2["last_loaded"] == dt.date(2017, 8, 18) and r2["inserted"] == 2
    # same source again: nothing new, watermark unchanged
    r3 = ingest.load_increment(spark, second, bronze, ck, TS)
    assert r3["inserted"] == 0 and r3["new_checkpoint"] is None
    assert ingest.read_checkpoint(spark, ck) == dt.date(2017, 8, 20)
    b = ingest.read_bronze(spark, bronze)
    assert b.count() == 4
    assert b.columns == ingest.BRONZE_COLUMNS
    assert b.where(F.col("loaded_at") != F.lit(TS)).count() == 0


def test_replay_after_crash_does_not_duplicate(spark):
    root = fresh_dir(spark, "t-replay")
    bronze, ck = f"{root}/bronze", f"{root}/ck"
    src = raw_frame(spark, rows_for(["17/08/2017", "18/08/2017", "19/08/2017"]))
    ingest.load_increment(spark, src, bronze, ck, TS)
    # simulate a crash after the data write but before the watermark write
    ingest.write_checkpoint(spark, ck, dt.date(1900, 1, 1))
    ingest.load_increment(spark, src, bronze, ck, TS)
    assert ingest.read_bronze(spark, bronze).count() == 3


def test_empty_source_is_a_no_op(spark):
    root = fresh_dir(spark, "t-empty")
    src = raw_frame(spark, rows_for(["17/08/2017"], campaign="1"))
    r = ingest.load_increment(spark, src, f"{root}/bronze", f"{root}/ck", TS)
    assert r["inserted"] == 0
    assert ingest.read_checkpoint(spark, f"{root}/ck") == dt.date(1900, 1, 1)


def test_all_rules_mode_drops_rejected_rows(spark):
    src = raw_frame(spark, rows_for(["17/08/2017"]) + [
        ok(ad_id="9", spent="-3"), ok(ad_id="0")])  # negative spend, duplicate of row 0
    assert ingest.incremental_new_rows(src, "1900-01-01").count() == 3
    assert ingest.incremental_new_rows(src, "1900-01-01", rules="all").count() == 1


def test_typed_columns(spark):
    src = raw_frame(spark, [ok(total_conversion=None, impressions="7350")])
    r = ingest.incremental_new_rows(src, "1900-01-01").first()
    assert r.reporting_start == dt.date(2017, 8, 17) and r.impressions == 7350.0
    assert r.total_conversion is None and r.clicks == 1 and r.ad_id == 1


def test_reset_clears_bronze_and_watermark(spark):
    root = fresh_dir(spark, "t-reset")
    bronze, ck = f"{root}/bronze", f"{root}/ck"
    src = raw_frame(spark, rows_for(["17/08/2017", "18/08/2017"]))
    ingest.load_increment(spark, src, bronze, ck, TS)
    ingest.reset_load(spark, bronze, ck)
    assert ingest.read_bronze(spark, bronze).count() == 0
    assert ingest.read_checkpoint(spark, ck) == dt.date(1900, 1, 1)
    r = ingest.load_increment(spark, src, bronze, ck, TS)
    assert r["inserted"] == 2 and ingest.read_bronze(spark, bronze).count() == 2


def test_statistics_are_those_of_the_increment(spark):
    root = fresh_dir(spark, "t-stats")
    bronze, ck = f"{root}/bronze", f"{root}/ck"
    ingest.load_increment(spark, raw_frame(spark, rows_for(["17/08/2017", "18/08/2017"])), bronze, ck, TS)
    second = ingest.load_increment(spark, raw_frame(spark, rows_for(["18/08/2017", "19/08/2017"])), bronze, ck, TS)
    assert (second["inserted"], second["new_checkpoint"], second["null_ids"]) == (1, dt.date(2017, 8, 19), 0)


def test_lost_watermark_does_not_load_twice(spark):
    root = fresh_dir(spark, "t-lost")
    bronze, ck = f"{root}/bronze", f"{root}/ck"
    src = raw_frame(spark, rows_for(["17/08/2017", "18/08/2017"]))
    ingest.load_increment(spark, src, bronze, ck, TS)
    assert ingest.read_checkpoint(spark, f"{root}/other") == dt.date(1900, 1, 1)  # gone
    assert ingest.load_increment(spark, src, bronze, f"{root}/other", TS)["inserted"] == 0
    assert ingest.read_bronze(spark, bronze).count() == 2


def test_an_increment_that_died_while_writing_is_redone(spark, monkeypatch):
    root = fresh_dir(spark, "t-died")
    bronze, ck = f"{root}/bronze", f"{root}/ck"
    src = raw_frame(spark, rows_for(["17/08/2017", "18/08/2017"]))

    def dead(*a, **k):
        raise RuntimeError("dead before the commit")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", dead)
        with pytest.raises(RuntimeError):
            ingest.load_increment(spark, src, bronze, ck, TS)
    assert ingest.read_bronze(spark, bronze).count() == 0
    assert ingest.load_increment(spark, src, bronze, ck, TS)["inserted"] == 2
    assert ingest.read_bronze(spark, bronze).count() == 2


def test_a_date_prunes_bronze(spark):
    root = fresh_dir(spark, "t-prune")
    bronze, ck = f"{root}/bronze", f"{root}/ck"
    ingest.load_increment(spark, raw_frame(spark, rows_for(["17/08/2017", "18/08/2017"])), bronze, ck, TS)
    ingest.load_increment(spark, raw_frame(spark, rows_for(["01/10/2017"])), bronze, ck, TS)
    late = ingest.read_bronze(spark, bronze, dt.date(2017, 9, 17))
    assert late.count() == 1 and all("month=2017-10" in f for f in late.inputFiles())


def test_duplicates_over_all_loads(spark):
    """Rule 4 with an index: a key of an earlier load, of a rejected row too, is a duplicate."""
    root = fresh_dir(spark, "t-keys")
    args = (f"{root}/bronze", f"{root}/ck", TS, "all")
    first = raw_frame(spark, [ok(ad_id="1"), ok(ad_id="2", reporting_start="19/08/2017", campaign_id="0"),
                              ok(ad_id=None, reporting_start="01/09/2017", campaign_id="0")])
    assert ingest.load_increment(spark, first, *args)["inserted"] == 1
    later = raw_frame(spark, [ok(ad_id="2", reporting_start="19/08/2017"), ok(ad_id="3", reporting_start="19/08/2017"),
                              ok(ad_id=None, reporting_start="01/09/2017"), ok(ad_id="4", reporting_start="02/09/2017"),
                              ok(ad_id="4", reporting_start="02/09/2017")])
    assert ingest.load_increment(spark, later, *args)["inserted"] == 2
    ids = sorted(r[0] for r in ingest.read_bronze(spark, args[0]).select("ad_id").collect())
    assert ids == [1, 3, 4]
    table = VersionedTable(spark, args[0])
    keys = table.read(schema=ingest.KEY_SCHEMA, kind=ingest.KEYS)
    assert keys.count() == 5 == keys.distinct().count()


def test_many_increments_are_joined(spark, monkeypatch):
    monkeypatch.setattr(ingest, "MOST_FOLDERS", 3)
    root = fresh_dir(spark, "t-compact")
    args = (f"{root}/bronze", f"{root}/ck", TS, "all")
    for d in range(1, 8):
        ingest.load_increment(spark, raw_frame(spark, rows_for([f"{d:02d}/08/2017"])), *args)
        table = VersionedTable(spark, args[0])
        ingest.compact(spark, args[0], 3)
    at = table.current()
    assert sum(1 for f in at.folders if not f.kind) <= 4 and at.state["seq"] == 7
    assert ingest.read_bronze(spark, args[0]).count() == 7
    assert table.read(at, schema=ingest.KEY_SCHEMA, kind=ingest.KEYS).count() == 7
    assert at.months(after_seq=6) == ["2017-08"] and at.months(after_seq=7) == []


def test_ids_keep_their_digits(spark):
    src = raw_frame(spark, [ok(ad_id=x) for x in ("9007199254740993", "3000000000", "12.0", "3.7", "x")])
    ids = [r.ad_id for r in ingest.incremental_new_rows(src, "1900-01-01").collect()]
    assert ids == [9007199254740993, 3000000000, 12, None, None]
    root = fresh_dir(spark, "t-ids")
    assert ingest.load_increment(spark, src, f"{root}/b", f"{root}/ck", TS)["null_ids"] == 2


def test_a_long_list_of_campaigns_is_joined(spark):
    src = raw_frame(spark, rows_for(["17/08/2017"], "c7") + rows_for(["17/08/2017"], "916"))
    ids = [f"c{i}" for i in range(500)]
    assert [r.campaign_id for r in ingest.incremental_new_rows(src, "1900-01-01", campaign_ids=ids).collect()] == ["c7"]
    frame = spark.createDataFrame([("916",)], "id string")
    assert [r.campaign_id for r in ingest.incremental_new_rows(src, "1900-01-01", campaign_ids=frame).collect()] == ["916"]


def test_the_load_is_small_enough_to_be_compiled(spark, tmp_path, capsys):
    """A filter on the date inlines its reading; beyond 8,000 bytes the JVM interprets a generated method for good."""
    import re

    from adlens.sources.testdata import ad_rows_from_lineitem

    schema = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
              "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
              "l_shipdate timestamp_ntz")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = ingest.incremental_new_rows(ad_rows_from_lineitem(spark, str(tmp_path)), "1995-06-17")
    loaded = ingest.stamp(rows, "2024-01-01").withColumn("month", ingest.month_of("reporting_start"))
    capsys.readouterr()
    loaded.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_whole_numbers_with_and_without_a_point(spark):
    from adlens.functions import whole_number

    texts = ["12", " 12 ", "12.", "12.00", "3.7", "1.0.0", "", "x", None, "-4", "12.0 ", "9223372036854775807"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(whole_number("t")).collect()]
    assert got == [12, 12, 12, 12, None, None, None, None, None, -4, 12, 9223372036854775807]

"""The incremental load as a stream over raw CSV files arriving in a folder."""

import csv
import datetime as dt
import os

import pytest

from adlens.config import RAW_COLUMNS
from adlens.operators import ingest
from adlens.session import fresh_dir, local_path
from adlens.streaming.incremental import raw_csv_stream, stream_incremental_load
from tests.test_validate import ok

TS = dt.datetime(2024, 1, 1)


def write_csv(path, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(RAW_COLUMNS)
        for r in rows:
            w.writerow(["" if r.get(c) is None else r[c] for c in RAW_COLUMNS])


def day_rows(prefix, days):
    return [ok(ad_id=f"{prefix}{i}", reporting_start=d, reporting_end=d)
            for i, d in enumerate(days)]


def test_stream_load_two_arrivals(spark):
    root = fresh_dir(spark, "t-stream")
    src = local_path(root) + "/incoming"
    os.makedirs(src)
    write_csv(f"{src}/part1.csv", day_rows("a", ["17/08/2017", "18/08/2017"])
              + [ok(ad_id="bad", campaign_id="45-49")])
    args = (f"{root}/bronze", f"{root}/wm", f"{root}/ck")
    rep1 = stream_incremental_load(spark, raw_csv_stream(spark, src), *args, loaded_at=TS)
    assert sum(r["inserted"] for r in rep1) == 2
    # second arrival: one row at the watermark date (late, dropped) and one newer
    write_csv(f"{src}/part2.csv", day_rows("b", ["18/08/2017", "19/08/2017"]))
    rep2 = stream_incremental_load(spark, raw_csv_stream(spark, src), *args, loaded_at=TS)
    assert sum(r["inserted"] for r in rep2) == 1
    # nothing new: the file source does not re-read processed files
    rep3 = stream_incremental_load(spark, raw_csv_stream(spark, src), *args, loaded_at=TS)
    assert sum(r["inserted"] for r in rep3) == 0
    assert ingest.read_bronze(spark, f"{root}/bronze").count() == 3
    assert ingest.read_checkpoint(spark, f"{root}/wm") == dt.date(2017, 8, 19)


def test_stream_backlog_in_bounded_batches(spark):
    root = fresh_dir(spark, "t-stream-bounded")
    src = local_path(root) + "/incoming"
    os.makedirs(src)
    write_csv(f"{src}/p1.csv", day_rows("a", ["17/08/2017"]))
    write_csv(f"{src}/p2.csv", day_rows("b", ["18/08/2017"]))
    write_csv(f"{src}/p3.csv", day_rows("c", ["19/08/2017", "20/08/2017"]))
    # the file source takes files in modification-time order
    for i, name in enumerate(["p1.csv", "p2.csv", "p3.csv"]):
        os.utime(f"{src}/{name}", (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    reps = stream_incremental_load(
        spark, raw_csv_stream(spark, src, max_files_per_trigger=1),
        f"{root}/bronze", f"{root}/wm", f"{root}/ck", loaded_at=TS)
    assert len(reps) >= 2
    assert ingest.read_bronze(spark, f"{root}/bronze").count() == 4
    assert ingest.read_checkpoint(spark, f"{root}/wm") == dt.date(2017, 8, 20)


def load_all(spark, name, files, max_files, rules="campaign"):
    root = fresh_dir(spark, name)
    src = local_path(root) + "/incoming"
    os.makedirs(src)
    for i, (f, rows) in enumerate(files):
        write_csv(f"{src}/{f}", rows)
        os.utime(f"{src}/{f}", (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    stream_incremental_load(spark, raw_csv_stream(spark, src, max_files), f"{root}/bronze", f"{root}/wm",
                            f"{root}/ck", loaded_at=TS, rules=rules)
    rows = ingest.read_bronze(spark, f"{root}/bronze").select("campaign_id", "reporting_start", "spent").collect()
    return sorted(map(tuple, rows)), ingest.read_checkpoint(spark, f"{root}/wm")


def test_rows_loaded_do_not_depend_on_batches_or_file_order(spark):
    files = [("p1.csv", day_rows("a", ["20/08/2017"])), ("p2.csv", day_rows("b", ["18/08/2017", "19/08/2017"]))]
    once = load_all(spark, "t-stream-once", files, None)
    assert len(once[0]) == 3 and once[1] == dt.date(2017, 8, 20)
    assert load_all(spark, "t-stream-one", files, 1) == once
    assert load_all(spark, "t-stream-back", files[::-1], 1) == once


def test_all_rules_on_a_stream(spark):
    files = [("p1.csv", day_rows("a", ["20/08/2017"]) + [ok(ad_id="n", spent="-1"), ok(ad_id="a0", reporting_start="20/08/2017")])]
    assert len(load_all(spark, "t-stream-all", files, None, "all")[0]) == 1


def test_all_rules_do_not_depend_on_batches(spark):
    """The same key in two files, once behind a rejected row: one batch or two load the same rows."""
    files = [("p1.csv", [ok(ad_id="1"), ok(ad_id="2", campaign_id="0")]), ("p2.csv", [ok(ad_id="1", spent="7"), ok(ad_id="2"), ok(ad_id="3")])]
    once = load_all(spark, "t-stream-key-once", files, None, "all")
    assert len(once[0]) == 2
    assert load_all(spark, "t-stream-key-two", files, 1, "all") == once


def test_a_run_taken_up_again_goes_on_from_its_start(spark):
    """A run dies in its second micro-batch; taken up again it loads that one, and nothing twice."""
    root = fresh_dir(spark, "t-stream-crash")
    src = local_path(root) + "/incoming"
    os.makedirs(src)
    args = (f"{root}/bronze", f"{root}/wm", f"{root}/ck")
    write_csv(f"{src}/p1.csv", day_rows("a", ["20/08/2017"]))
    write_csv(f"{src}/p2.csv", [ok(ad_id="b0", reporting_start="no date")])
    for i, name in enumerate(["p1.csv", "p2.csv"]):
        os.utime(f"{src}/{name}", (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    with pytest.raises(Exception, match="unparsable"):
        stream_incremental_load(spark, raw_csv_stream(spark, src, 1), *args, loaded_at=TS)
    assert ingest.read_bronze(spark, args[0]).count() == 1
    assert ingest.read_checkpoint(spark, args[1], args[0]) == dt.date(1900, 1, 1)  # the run has not ended
    write_csv(f"{src}/p2.csv", day_rows("b", ["18/08/2017"]))
    stream_incremental_load(spark, raw_csv_stream(spark, src, 1), *args, loaded_at=TS)
    assert ingest.read_bronze(spark, args[0]).count() == 2
    assert ingest.read_checkpoint(spark, args[1]) == dt.date(2017, 8, 20)


def test_a_replayed_micro_batch_is_not_loaded_again(spark):
    """The commit of a micro-batch is in, the stream's own note of it is lost: it comes once more."""
    root = fresh_dir(spark, "t-stream-replay")
    src = local_path(root) + "/incoming"
    os.makedirs(src)
    args = (f"{root}/bronze", f"{root}/wm", f"{root}/ck")
    write_csv(f"{src}/p1.csv", day_rows("a", ["20/08/2017", "21/08/2017"]))
    stream_incremental_load(spark, raw_csv_stream(spark, src), *args, loaded_at=TS)
    for f in os.listdir(local_path(root) + "/ck/commits"):
        os.remove(f"{local_path(root)}/ck/commits/{f}")
    assert stream_incremental_load(spark, raw_csv_stream(spark, src), *args, loaded_at=TS) == []
    assert ingest.read_bronze(spark, args[0]).count() == 2


def test_stream_of_all_rules_sorts_a_bounded_number_of_rows_a_file(spark, tmp_path, monkeypatch):
    """Ten times the rows make ten times the files, in four micro-batches still, and load the same rows."""
    from pyspark.sql import functions as F

    from adlens.plans import catalog
    from adlens.streaming import incremental

    rows = spark.range(400).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit(9.0).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax"), F.lit("A").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        F.expr("cast(date_add(date'1996-01-01', cast(id % 20 as int)) as timestamp_ntz)").alias("l_shipdate"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, batches = [], []
    written, loaded = catalog.list_names, incremental.add_increment
    monkeypatch.setattr(catalog, "list_names", lambda s, path: seen.append(path) or written(s, path))
    monkeypatch.setattr(incremental, "add_increment", lambda *a: batches.append(1) or loaded(*a))
    got = [sorted(map(tuple, catalog._stream_all_rules(spark, str(tmp_path), n).collect())) for n in (100, 10)]
    assert got[0] == got[1] and len(got[0]) == 20
    sizes = [spark.read.option("header", True).csv(path).groupBy(F.input_file_name()).count().agg(
        F.count("*"), F.max("count")).first() for path in seen]
    assert sizes[0][0] == 4 and sizes[1][0] >= 30 and sizes[1][1] <= 30
    assert len(batches) == 8

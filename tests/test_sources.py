"""Raw CSV source: all text, NA tokens, source order, over-long rows."""

import os

import pytest

from adlens.config import RAW_COLUMNS
from adlens.operators import validate
from adlens.session import fresh_dir, local_path
from adlens.sources.raw import SEQ, land_raw, raw_rows, read_raw_csv
from adlens.streaming.incremental import raw_csv_stream


def _write(path, lines):
    with open(path, "w") as f:
        f.write(",".join(RAW_COLUMNS) + "\n")
        for line in lines:
            f.write(line + "\n")


ROW = "{id},17/08/2017,17/08/2017,916,103916,30-34,M,15,17,17,7350,1,1.43,{tc},1"


def test_read_raw_csv_text_na_and_order(spark):
    d = local_path(fresh_dir(spark, "t-csv"))
    import os
    os.makedirs(d)
    _write(f"{d}/a.csv", [ROW.format(id="1", tc="2"), ROW.format(id="1", tc="NA"),
                          ROW.format(id="2", tc="")])
    _write(f"{d}/b.csv", [ROW.format(id="1", tc="3")])
    raw = read_raw_csv(spark, d)
    assert all(t == "string" for c, t in raw.dtypes if c != SEQ)
    rows = raw.orderBy(SEQ).collect()
    assert [r.total_conversion for r in rows] == ["2", None, None, "3"]
    # the first copy of ad 1 in file order is kept; the later ones are duplicates
    reasons = [r.rejection_reason for r in
               validate.with_rejection_reason(raw).orderBy(SEQ).collect()]
    assert reasons == [None, "duplicate_ad_id", None, "duplicate_ad_id"]


def test_over_long_row_stops_the_job(spark):
    d = local_path(fresh_dir(spark, "t-csv-long"))
    import os
    os.makedirs(d)
    _write(f"{d}/a.csv", [ROW.format(id="1", tc="2") + ",extra"])
    with pytest.raises(Exception, match="malformed raw row"):
        read_raw_csv(spark, d).collect()


def _folder(spark, name, files):
    d = local_path(fresh_dir(spark, name))
    os.makedirs(d)
    for f, lines in files.items():
        _write(f"{d}/{f}", lines)
    return d


SHIFTED = "{id},17/08/2017,17/08/2017,45-49,M,10,16,17,7350,1,1.43,2,1"  # two fields lost on the way


def test_short_rows_are_padded_and_rejected_by_name(spark):
    d = _folder(spark, "t-csv-short", {"a.csv": [ROW.format(id="1", tc="2"), SHIFTED.format(id="2"),
                                                 ROW.format(id="3", tc="2")]})
    raw = read_raw_csv(spark, d)
    rows = {r.ad_id: r for r in validate.with_rejection_reason(raw).collect()}
    assert rows["2"].approved_conversion is None and rows["2"].total_conversion is None
    assert rows["2"].rejection_reason == "invalid_campaign_id"
    assert rows["1"].rejection_reason is None and rows["3"].rejection_reason is None


def test_commas_in_quotes_are_no_fields(spark):
    d = _folder(spark, "t-csv-quotes", {"a.csv": ['1,17/08/2017,17/08/2017,"9,1,6",1,30-34,M,15']})
    assert [r.campaign_id for r in read_raw_csv(spark, d).collect()] == ["9,1,6"]


def test_landed_rows_keep_their_order_as_one_number(spark):
    files = {f"f{k}.csv": [ROW.format(id=f"{k}{i}", tc="2") for i in range(20)] for k in (3, 1, 2)}
    raw = read_raw_csv(spark, _folder(spark, "t-csv-land", files))
    landed = land_raw(raw, 3)
    assert dict(landed.dtypes)[SEQ] == "bigint" and landed.columns[:-1] == list(RAW_COLUMNS)
    want = [f"{k}{i}" for k in (1, 2, 3) for i in range(20)]
    assert [r.ad_id for r in landed.orderBy(SEQ).collect()] == want
    plan = validate.with_rejection_reason(landed)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_a_stream_reads_as_the_batch_does(spark):
    d = _folder(spark, "t-csv-both", {"a.csv": [ROW.format(id="1", tc="NA"), SHIFTED.format(id="2")]})
    path, seen = fresh_dir(spark, "t-csv-both-ck"), []
    (raw_csv_stream(spark, d).writeStream.foreachBatch(
        lambda b, _: seen.extend(tuple(r) for r in raw_rows(b).drop(SEQ).collect()))
     .option("checkpointLocation", path).trigger(availableNow=True).start().awaitTermination())
    assert sorted(seen, key=str) == sorted((tuple(r) for r in read_raw_csv(spark, d).drop(SEQ).collect()), key=str)


def test_width_is_checked_in_one_pass(spark, tmp_path):
    """A quoted comma is no separator, and a very long malformed line is checked in step with its length."""
    import time

    from adlens.config import RAW_COLUMNS
    n = len(RAW_COLUMNS)
    (tmp_path / "a.csv").write_text(",".join(RAW_COLUMNS) + "\n" + '"a,b' * 3 + '",' + "x," * (n - 2) + "x\n")
    assert read_raw_csv(spark, str(tmp_path / "a.csv")).count() == 1
    (tmp_path / "b.csv").write_text(",".join(RAW_COLUMNS) + "\n" + ",".join(['"x,y"'] * 20_000) + "\n")
    took = time.perf_counter()
    with pytest.raises(Exception, match="malformed raw row"):
        read_raw_csv(spark, str(tmp_path / "b.csv")).collect()
    assert time.perf_counter() - took < 60

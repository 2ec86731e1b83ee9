"""Versioned tables: readers keep their version, writers that die leave nothing, months are pruned."""

import pytest

from adlens.session import fresh_dir, list_names
from adlens.versions import Folder, VersionedTable


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "x long")


def values(df):
    return sorted(r[0] for r in df.select("x").collect())


def test_a_reader_keeps_the_version_it_looked_up(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-version"))
    assert t.current().version == 0
    t.replace(frame(spark, 1, 2))
    before = t.read()
    t.replace(frame(spark, 3))
    assert values(before) == [1, 2] and values(t.read()) == [3]


def test_a_writer_that_dies_changes_nothing(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-died"))
    t.replace(frame(spark, 1))
    t.write(frame(spark, 2))  # written, then dead before its commit
    bad = frame(spark, 3).selectExpr("raise_error('dead') as x")
    with pytest.raises(Exception, match="dead"):
        t.replace(bad)  # dead while writing
    assert values(t.read()) == [1] and t.current().version == 1
    assert t.vacuum() == 2 and values(t.read()) == [1]


def test_of_two_writers_one_fails(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-two"))
    base = t.current()
    t.commit(base, t.write(frame(spark, 1)), frame(spark, 1).schema)
    with pytest.raises(Exception, match="(?i)exist"):
        t.commit(base, t.write(frame(spark, 2)), frame(spark, 2).schema)
    assert values(t.read()) == [1]
    assert not [n for n in list_names(spark, f"{t.path}/_commits") if n.endswith(".tmp")]


def test_months(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-months"))
    df = spark.createDataFrame([(1, "2017-07"), (2, "2017-08"), (3, "2017-08")], "x long, month string")
    folders = t.write(df, by_month=True)
    assert sorted(f.month for f in folders) == ["2017-07", "2017-08"]
    c = t.commit(t.current(), [Folder(f.path, f.month, 1) for f in folders], df.drop("month").schema, {"through": 1})
    assert c.months() == ["2017-07", "2017-08"] and c.months(after_seq=1) == []
    late = t.read(months=["2017-08", "2019-01"])
    assert values(late) == [2, 3] and late.columns == ["x"]
    assert len(late.inputFiles()) <= 2 and all("2017-08" in f for f in late.inputFiles())
    assert values(t.read(months=[])) == []
    assert t.current().state == {"through": 1}


def test_vacuum_keeps_the_last_versions(spark):
    t = VersionedTable(spark, fresh_dir(spark, "t-vacuum"))
    for k in range(5):
        t.replace(frame(spark, k))
    old = t.read(t._commit(4))
    assert t.vacuum(keep=2) == 3
    assert values(old) == [3] and values(t.read()) == [4]
    assert len(t._numbers()) == 2


def test_months_of_increments(spark, monkeypatch):
    """A folder an increment; months that a later one replaced no longer count; many folders are joined."""
    t = VersionedTable(spark, fresh_dir(spark, "t-live"))

    def rows(**months):
        return spark.createDataFrame([(x, m[1:].replace("_", "-")) for m, xs in months.items() for x in xs], "x long, month string")

    t.replace_months(t.current(), None, rows(_2017_07=[1], _2017_08=[2]), ["2017-07", "2017-08", "2017-09"], {"n": 1})
    t.replace_months(t.current(), ["2017-08", "2017-09"], rows(_2017_08=[3, 4], _2017_09=[5]), [], {"n": 2})
    assert values(t.read()) == [1, 3, 4, 5] and values(t.read(months=["2017-08"])) == [3, 4]
    assert t.current().months() == ["2017-07", "2017-08", "2017-09"]
    t.replace_months(t.current(), ["2017-07"], rows(_2017_07=[6]), [], {"n": 3})
    assert values(t.read()) == [3, 4, 5, 6] and len(t.current().folders) == 2
    monkeypatch.setattr("adlens.versions.MOST_PARTS", 2)
    t.replace_months(t.current(), ["2017-10"], rows(_2017_10=[7]), [], {"n": 4})
    at = t.current()
    assert len(at.folders) == 1 and at.state == {"n": 4} and values(t.read(at)) == [3, 4, 5, 6, 7]
    assert at.months() == ["2017-07", "2017-08", "2017-09", "2017-10"]

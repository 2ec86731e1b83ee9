import math
import random
import statistics

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.functions import (
    clean_number,
    fixed,
    money_sum,
    parse_day_first,
    ratio,
    round_half_away,
    round_half_away_value,
)
from adlens.functions.stats import exact_medians, grouped_medians


def test_round_matches_sql_round(spark):
    rnd = random.Random(7)
    xs = [rnd.uniform(-1000, 1000) for _ in range(3000)] + [
        1.005, 2.675, 0.285, -1.005, 5.68875, 0.5, -2.5, 1.00005, 0.0]
    con = duckdb.connect()
    for n in (0, 1, 2, 4):
        exp = [r[0] for r in con.execute(
            f"SELECT ROUND(x, {n}) FROM unnest(?::DOUBLE[]) t(x)", [xs]).fetchall()]
        got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double")
               .select(round_half_away("x", n)).collect()]
        assert got == exp


def test_ratio_is_null_on_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (3, 4), (None, 2)], "a long, b long")
    assert [r[0] for r in df.select(ratio("a", "b", 100.0)).collect()] == [None, 75.0, None]


@pytest.mark.parametrize("text,value", [
    ("12", 12.0), (" 3.5 ", 3.5), ("-2e2", -200.0), (".5", 0.5),
    ("NaN", None), ("1d", None), ("abc", None), ("Infinity", None), (None, None)])
def test_clean_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(clean_number("t")).first()[0] == value


def test_parse_day_first(spark):
    import datetime as dt
    df = spark.createDataFrame([("17/08/2017",), ("1/2/2017",), ("2017-08-05",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_day_first("t")).collect()]
    assert got == [dt.date(2017, 8, 17), dt.date(2017, 2, 1), dt.date(2017, 8, 5), None]


def test_parse_day_first_fails_loudly(spark):
    df = spark.createDataFrame([("32/13/2017",)], "t string")
    with pytest.raises(Exception, match="unparsable"):
        df.select(parse_day_first("t")).collect()


def test_fixed_decimals(spark):
    df = spark.createDataFrame([(12.3,), (0.00005,), (-0.04,), (157.65,)], "x double")
    assert [r[0] for r in df.select(fixed("x", 1)).collect()] == ["12.3", "0.0", "0.0", "157.7"]
    assert [r[0] for r in df.select(fixed("x", 4)).collect()] == [
        "12.3000", "0.0001", "-0.0400", "157.6500"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 11, 500])
def test_exact_median_matches_statistics(spark, n):
    import statistics

    from adlens.functions.stats import exact_medians
    rnd = random.Random(n)
    a = [float(rnd.randint(0, 20)) for _ in range(n)] + [None, None]
    b = [rnd.uniform(-5, 5) for _ in range(n)] + [None, 1.0]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = exact_medians(df, {"a": "ma", "b": "mb"}, partitions=4).first()
    exp_a = statistics.median([x for x in a if x is not None]) if n else None
    exp_b = statistics.median([x for x in b if x is not None])
    assert got["ma"] == exp_a
    assert got["mb"] == pytest.approx(exp_b, abs=1e-12)


def test_round_leaves_what_has_no_digits_to_round(spark):
    xs = [1e15, -1e17, 9007199254740993.0, 1e300, 4503599627370497.5]
    for n in (0, 2, 4):
        got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double")
               .select(round_half_away("x", n)).collect()]
        assert got[1:4] == xs[1:4] and got[0] == 1e15
        assert [round_half_away_value(x, n) for x in xs[1:4]] == xs[1:4]


@pytest.mark.parametrize("xs", [[0.0000004] * 1000, [1.42999994804] * 1000, [2e12, 0.1], [1e30, 1.0, -1e30],
                                [0.1] * 10, [123456789.123456789] * 7])
def test_money_sum_cuts_nothing(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(3)
    got = df.agg(money_sum("x")).first()[0]
    assert got == pytest.approx(math.fsum(xs), rel=1e-15, abs=1e-3 if max(xs) > 1e26 else 1e-18)
    over = df.select(money_sum("x", Window.partitionBy(F.lit(0)))).first()[0]
    assert over == got


def test_money_sum_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(money_sum("x")).first()[0] is None


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_medians_on_one_path(spark, reuse, adaptive):
    """A value in nine tenths of the rows, missing values, and groups."""
    rnd = random.Random(5)
    rows = [(k % 3, None if k % 50 == 0 else (-3.0 if rnd.random() < 0.9 else rnd.uniform(-100, 100)), rnd.uniform(0, 100))
            for k in range(2000)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        df = spark.createDataFrame(rows, "g long, a double, b double")
        got = exact_medians(df, {"a": "ma", "b": "mb"}).first()
        assert got["ma"] == statistics.median(r[1] for r in rows if r[1] is not None)
        assert got["mb"] == pytest.approx(statistics.median(r[2] for r in rows))
        by = {r["g"]: r["mb"] for r in grouped_medians(df, ["g"], {"b": "mb"}).collect()}
        assert by == pytest.approx({g: statistics.median(r[2] for r in rows if r[0] == g) for g in range(3)})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

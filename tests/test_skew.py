"""The pipeline on a skewed input: a third of all rows on one key and one campaign."""

import datetime as dt

from pyspark.sql import functions as F

import tools_skew
from adlens.operators import validate
from adlens.plans.catalog import Pipeline
from adlens.plans.pipeline import run_pipeline
from adlens.sources.testdata import ad_rows_from_lineitem
from tests.conftest import SF001


def test_pipeline_on_hot_key_matches_lazy_and_keeps_one_row(spark):
    raw = tools_skew.skewed(ad_rows_from_lineitem(spark, SF001))
    hot = (F.col("ad_id") == "777") & (F.col("reporting_start") == "01/01/1998")
    n_hot = raw.where(hot).count()
    assert n_hot > raw.count() / 4
    checked = validate.with_rejection_reason(raw).where(hot)
    assert checked.where(F.col("rejection_reason").isNull()).count() <= 1
    assert checked.where(F.col("rejection_reason") == "duplicate_ad_id").count() >= n_hot / 2

    wh, rep = run_pipeline(spark, raw, run_ts=dt.datetime(2024, 1, 1))
    lazy = Pipeline(raw)
    assert sorted(map(tuple, wh.read(spark, "fact_campaign_performance").collect())) == \
        sorted(map(tuple, lazy.fact.collect()))
    got = sorted(map(tuple, wh.read(spark, "mart_campaign_kpis").drop("last_updated").collect()))
    assert got == sorted(map(tuple, lazy.kpis.collect()))
    assert rep.validation["valid_rows"] + rep.validation["rejected_rows"] == raw.count()

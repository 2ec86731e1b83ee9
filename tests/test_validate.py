"""Validation rules on hand-made edge frames."""

import json

import pytest
from pyspark.sql import functions as F

from adlens.config import RAW_COLUMNS
from adlens.operators import validate
from adlens.sources.raw import SEQ, normalize_raw


def raw_frame(spark, rows):
    """rows: dicts of raw text values (missing keys → NULL), in source order."""
    data = [tuple(r.get(c) for c in RAW_COLUMNS) + (i,) for i, r in enumerate(rows)]
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS) + f", {SEQ} long"
    return normalize_raw(spark.createDataFrame(data, schema))


def ok(**kw):
    base = {"ad_id": "1", "reporting_start": "17/08/2017", "reporting_end": "17/08/2017",
            "campaign_id": "916", "fb_campaign_id": "103916", "age": "30-34", "gender": "M",
            "interest1": "15", "interest2": "17", "interest3": "17", "impressions": "7350",
            "clicks": "1", "spent": "1.43", "total_conversion": "2", "approved_conversion": "1"}
    base.update(kw)
    return base


def reasons(spark, rows):
    out = validate.with_rejection_reason(raw_frame(spark, rows)).orderBy(SEQ).collect()
    return [r.rejection_reason for r in out]


def test_rule_order_first_failure_wins(spark):
    rows = [
        ok(ad_id="1"),
        ok(ad_id="2", campaign_id="45-49", total_conversion=None, approved_conversion=None),
        ok(ad_id="3", total_conversion=None, approved_conversion=None, spent="-1"),
        ok(ad_id="4", spent="-0.5"),
        ok(ad_id="1"),  # duplicate of the first row
    ]
    assert reasons(spark, rows) == [
        None, "invalid_campaign_id", "null_conversion", "negative_spend", "duplicate_ad_id"]


def test_missing_campaign_and_na_tokens(spark):
    rows = [ok(ad_id="1", campaign_id=None), ok(ad_id="2", campaign_id="NA"),
            ok(ad_id="3", campaign_id="")]
    assert reasons(spark, rows) == ["invalid_campaign_id"] * 3


def test_one_conversion_missing_passes_both_missing_fails(spark):
    rows = [ok(ad_id="1", total_conversion=None), ok(ad_id="2", approved_conversion="nan"),
            ok(ad_id="3", total_conversion="abc", approved_conversion="NaN")]
    assert reasons(spark, rows) == [None, None, "null_conversion"]


def test_missing_or_text_spend_passes(spark):
    rows = [ok(ad_id="1", spent=None), ok(ad_id="2", spent="n/a"), ok(ad_id="3", spent="x")]
    assert reasons(spark, rows) == [None, None, None]


def test_duplicate_counted_over_rejected_rows(spark):
    # the first copy is rejected by rule 1; the second is still a duplicate
    rows = [ok(ad_id="7", campaign_id="999"), ok(ad_id="7"), ok(ad_id="7")]
    assert reasons(spark, rows) == ["invalid_campaign_id", "duplicate_ad_id", "duplicate_ad_id"]


def test_duplicate_with_missing_key_parts(spark):
    rows = [ok(ad_id=None), ok(ad_id=None), ok(ad_id=None, reporting_start=None),
            ok(ad_id="5", reporting_start=None), ok(ad_id="5", reporting_start=None)]
    assert reasons(spark, rows) == [None, "duplicate_ad_id", None, None, "duplicate_ad_id"]


def test_duplicate_keeps_first_in_source_order_not_input_order(spark):
    rows = [ok(ad_id="9", clicks="1"), ok(ad_id="9", clicks="2")]
    df = raw_frame(spark, rows).withColumn(SEQ, 10 - F.col(SEQ))  # second row comes first
    out = {r.clicks: r.rejection_reason
           for r in validate.with_rejection_reason(df).collect()}
    assert out == {"2": None, "1": "duplicate_ad_id"}


def test_hot_duplicate_key(spark):
    rows = [ok(ad_id="h") for _ in range(500)] + [ok(ad_id=str(i)) for i in range(100)]
    rs = reasons(spark, rows)
    assert rs[0] is None and rs[1:500] == ["duplicate_ad_id"] * 499 and set(rs[500:]) == {None}


def test_no_rejection(spark):
    rows = [ok(ad_id=str(i)) for i in range(5)]
    checked = validate.with_rejection_reason(raw_frame(spark, rows))
    s = validate.validation_summary(checked).first()
    assert (s.total_rows, s.valid_rows, s.rejected_rows, s.pct_rejected) == (5, 5, 0, 0.0)
    assert validate.validation_log(checked).count() == 0
    assert validate.rejection_breakdown(checked).count() == 0


def test_summary_and_log(spark):
    rows = [ok(ad_id="1"), ok(ad_id="2", campaign_id="45-49"), ok(ad_id="1"),
            ok(ad_id="3", spent="-2")]
    checked = validate.with_rejection_reason(raw_frame(spark, rows))
    s = validate.validation_summary(checked).first().asDict()
    assert s == {"total_rows": 4, "valid_rows": 1, "rejected_rows": 3, "pct_rejected": 75.0,
                 "reason_invalid_campaign": 1, "reason_null_conversion": 0,
                 "reason_negative_spend": 1, "reason_duplicate": 1}
    log = validate.validation_log(checked).orderBy("rejection_reason").collect()
    assert [r.rejection_reason for r in log] == [
        "duplicate_ad_id", "invalid_campaign_id", "negative_spend"]
    raw = json.loads(log[1].raw_row)
    assert list(raw) == list(RAW_COLUMNS) and raw["campaign_id"] == "45-49"
    assert valid_count(checked) == 1
    # invariant: valid + rejected = total
    assert s["valid_rows"] + s["rejected_rows"] == s["total_rows"]


def valid_count(checked):
    return validate.valid_rows(checked).count()


def test_json_keeps_missing_values_as_null(spark):
    checked = validate.with_rejection_reason(
        raw_frame(spark, [ok(campaign_id="x", total_conversion=None)]))
    raw = json.loads(validate.validation_log(checked).first().raw_row)
    assert raw["total_conversion"] is None


@pytest.mark.parametrize("bad", ["1178x", "0916"])
def test_campaign_ids_compared_as_text(spark, bad):
    assert reasons(spark, [ok(campaign_id=bad)]) == ["invalid_campaign_id"]


def _nodes(plan):
    """The nodes of an executed plan, those within query stages included."""
    yield plan
    name = plan.nodeName()
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if "QueryStage" in name else []
    kids = plan.children()
    for p in [*inner, *(kids.apply(i) for i in range(kids.size()))]:
        yield from _nodes(p)


def test_rows_of_keys_met_once_are_not_moved(spark):
    """Of 2,000 rows 20 have a repeated key: only these and the few that share a mark are shuffled whole."""
    rows = [ok(ad_id=str(i)) for i in range(1980)] + [ok(ad_id=str(i)) for i in range(20)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = validate.with_rejection_reason(raw_frame(spark, rows))
        # not by a plain count, which needs no row whole
        got = [r.rejection_reason for r in checked.collect()]
        moved = [n.metrics().get("shuffleRecordsWritten").get().value() for n in _nodes(checked._jdf.queryExecution().executedPlan())
                 if n.nodeName() == "Exchange" and "spent#" in n.output().mkString()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert (got.count(None), got.count("duplicate_ad_id")) == (1980, 20)
    assert sum(moved) < 100


def test_keys_that_share_a_mark_stay_apart(spark, monkeypatch):
    """With the fewest marks nearly all rows are compared in full; the flags are the same."""
    rows = [ok(ad_id=str(i % 150)) for i in range(200)] + [ok(ad_id=None), ok(ad_id=None, reporting_start=None)]
    many = reasons(spark, rows)
    monkeypatch.setattr(validate, "MARKS", 64)
    assert reasons(spark, rows) == many and many.count("duplicate_ad_id") == 50

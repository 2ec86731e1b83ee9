"""Validation against a brute-force model on random small frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adlens.config import NA_TOKENS
from adlens.operators import validate
from adlens.sources.raw import SEQ
from tests.test_validate import ok, raw_frame

TEXTS = st.sampled_from(["1", "0", "-2.5", "3e1", "abc", "NaN", "", "NA", None, "1d"])
ROWS = st.lists(st.fixed_dictionaries({
    "ad_id": st.sampled_from(["1", "2", "3", None, "NA"]),
    "reporting_start": st.sampled_from(["17/08/2017", "18/08/2017", None]),
    "campaign_id": st.sampled_from(["916", "936", "1178", "45-49", None, "9160"]),
    "spent": TEXTS, "total_conversion": TEXTS, "approved_conversion": TEXTS,
}), min_size=0, max_size=25)


def number(t):
    """A text read as a number by the rules: plain decimal or exponent form only."""
    if t is None or t in NA_TOKENS:
        return None
    if any(ch not in "0123456789.+-eE " for ch in t):
        return None
    try:
        return float(t)
    except ValueError:
        return None


def model(rows):
    norm = [{k: (None if v in NA_TOKENS else v) for k, v in r.items()} for r in rows]
    seen, out = set(), []
    for r in norm:
        key = (r["ad_id"], r["reporting_start"])
        dup = key in seen
        seen.add(key)
        spend = number(r["spent"])
        if r["campaign_id"] not in ("916", "936", "1178"):
            out.append("invalid_campaign_id")
        elif number(r["total_conversion"]) is None and number(r["approved_conversion"]) is None:
            out.append("null_conversion")
        elif spend is not None and spend < 0:
            out.append("negative_spend")
        elif dup:
            out.append("duplicate_ad_id")
        else:
            out.append(None)
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS)
def test_validation_matches_model(spark, rows):
    full = [ok(**r) for r in rows]
    df = raw_frame(spark, full)
    got = [r.rejection_reason for r in
           validate.with_rejection_reason(df).orderBy(SEQ).collect()]
    assert got == model(full)
    summary = validate.validation_summary(validate.with_rejection_reason(df)).first()
    assert summary.valid_rows + summary.rejected_rows == summary.total_rows == len(rows)

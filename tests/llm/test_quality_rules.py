import re

from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.llm.quality_rules import BASE, FULL, MEASURES, RULES, Policy, ablations, fails, ledger, measure

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é#*|\n\t\x0b\x1c ", max_size=60))
def test_measure(text):
    assert measure(text)[:5] == brute(text)


def test_edge_rows(edge, edge_rows):
    rows = ledger(edge).collect()
    assert sorted(tuple(r[m] for m in MEASURES[:5]) for r in rows) == sorted(
        measure(t)[:5] if len(t or "") > 1000 else brute(t) for _, t, *_ in edge_rows)
    few = [r for r in rows if r["n_words"] < 50]
    assert len(few) == len(edge_rows) - 1 and all(r["fail_bits"] & 1 for r in few)


def test_policies_and_ablations(small):
    book = ledger(small).cache()
    two = Policy("two", 3, ("few_words", "symbols"))
    rows = {(r["policy"], r["rule"]): r for r in ablations(book, [FULL, two]).collect()}
    bits = [r["fail_bits"] for r in book.collect()]
    for p in (FULL, two):
        for rule in p.rules:
            r, left = rows[p.name, rule], Policy("x", 1, tuple(x for x in p.rules if x != rule)).mask()
            assert (r["version"], r["documents"]) == (p.version, len(bits))
            assert r["kept"] == sum(b & p.mask() == 0 for b in bits)
            assert r["kept_without"] == sum(b & left == 0 for b in bits)
    assert book.where(fails(BASE)).count() == sum(b & 3 > 0 for b in bits)
    assert len(RULES) < 63


def test_verdicts_follow_the_labels(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = ledger(small).join(labels, "doc_id").where("fail_bits & 3 = 0")
    assert rows.where("quality = 1 and fail_bits > 0").count() == 0
    assert rows.where("quality = 0 and fail_bits = 0").count() == 0


def test_empty(empty):
    assert ledger(empty).collect() == []

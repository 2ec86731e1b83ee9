import hashlib

import pytest
from pyspark.sql import functions as F

from adlens.llm.common import LOWER, UPPER
from adlens.llm.exact_dedup import chunks, exact_dedup

LOW = str.maketrans(UPPER, LOWER)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in ids:
            stays = i == keep and first
            first = first and not stays
            out.append((i, keep, len(ids), stays, sha))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.drop("_row", "_place").collect()], key=str)


def test_against_brute_force(small):
    assert got(exact_dedup(small)) == brute([tuple(r) for r in small.select("doc_id", "text").collect()])


@pytest.mark.parametrize("weak", [False, True])
def test_edge_rows(edge, edge_rows, weak):
    """With a hash that collides for most chunks, contents are still told apart."""
    kind = {"hash_of": lambda c: F.length(c).cast("long") % 3} if weak else {}
    assert got(exact_dedup(edge, **kind)) == brute([(i, t) for i, t, *_ in edge_rows])


def test_chunks_are_the_text(small):
    joined = small.select("text", F.concat_ws("", chunks(F.col("text"))).alias("c"))
    assert joined.where("text <> c").count() == 0


def test_empty(empty):
    assert exact_dedup(empty).collect() == []


def test_hot_text(spark):
    """A third of all rows hold one text."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"),
                                  F.when(F.col("id") % 3 == 0, "Same text").otherwise(F.col("id").cast("string")).alias("text"))
    rows = exact_dedup(df)
    assert rows.where("kept").count() == 2001
    assert rows.where("group_size = 1000 and keep_id = 2997").count() == 1000

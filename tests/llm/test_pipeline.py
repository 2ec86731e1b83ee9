import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from adlens.llm.common import stored
from adlens.llm.near_dedup import near_dedup

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(__spark_entry__.queries())
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        rows = docs.collect()
        assert {r["doc_id"] for r in rows} <= set(before)
        if name != "mixing to target weights":
            assert all(r["text"] == before[r["doc_id"]] for r in rows)
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        kept[name] = rows
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    passed = {r["doc_id"] for r in kept["quality classifier"]}
    good = [d for d, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(d in passed for d in good) >= 0.97 * len(good)
    texts = [r["text"] for r in kept["exact dedup"]]
    assert len(texts) == len(set(texts)) and set(texts) == {r["text"] for r in kept["quality classifier"]}
    assert near_dedup(spark.createDataFrame(kept["MinHash near-dedup"])).where("not stays").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == len(kept["mixing to target weights"]) and all(r["round_trip"] for r in last)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("not round_trip or n_pieces <= 0").count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=lambda f: f.__name__)
def test_edge_rows_and_empty(spark, edge, empty, stage):
    out = stage(spark, edge, SF)
    assert out.count() > 0
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == edge.columns
        assert out.where(F.col("kept") != "extra kept").count() == 0
    assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=lambda f: f.__name__)
def test_other_splits_at_the_second_reading(spark, stage):
    """Cores come and go: the splits of the second scan of a stage differ from those of the first."""
    docs = stored(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "test-splits")
    want = stage(spark, docs, SF.replace("0.001", "0.01"))
    rows = sorted(map(tuple, want.collect()), key=str)
    names = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k", "spark.sql.leafNodeDefaultParallelism": "13"}
    out = stage(spark, docs, SF.replace("0.001", "0.01"))  # planned with the first scan's splits behind it
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        assert sorted(map(tuple, out.collect()), key=str) == rows
    finally:
        for k in names:
            spark.conf.unset(k)

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm.importance import best_cut, resample


def test_follows_the_labels(spark, small):
    """On labels that the model has not seen."""
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = resample(small, labels.where("doc_id % 2 = 0"))
    seen = rows.join(labels.where("doc_id % 2 = 1"), "doc_id")
    good, bad = seen.where("quality = 1 and toxic = 0"), seen.where("quality = 0")
    assert good.where("kept").count() >= 0.97 * good.count()
    assert bad.where("not kept").count() >= 0.95 * bad.count()


def test_few_labels(spark):
    """Good documents without a label stay, however few labels there are."""
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    learned = F.expr("pmod(xxhash64(doc_id), 20) = 0")
    rows = resample(spark.read.parquet(f"{d}/documents.parquet"), labels.where(learned))
    seen = rows.join(labels.where(~learned), "doc_id")
    good, bad = seen.where("quality = 1 and toxic = 0"), seen.where("quality = 0")
    rates = good.where("kept").count() / good.count(), bad.where("not kept").count() / bad.count()
    assert rates[0] >= 0.95 and rates[1] >= 0.85, rates


def test_is_gumbel_top_k(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = resample(small, labels).collect()
    k = sum(r["kept"] for r in rows)
    top = sorted(rows, key=lambda r: -r["key"])[:k]
    assert {r["doc_id"] for r in top} == {r["doc_id"] for r in rows if r["kept"]}
    noise = np.array([r["key"] - r["log_weight"] / 0.002 for r in rows])
    assert noise.mean() == pytest.approx(0.5772, abs=0.15)  # Gumbel
    assert noise.std() == pytest.approx(1.2825, abs=0.15)


def test_edge_rows(spark, edge, edge_rows):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 0, 0), (8, 1, 0), (None, 1, 0), (9, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows = resample(edge, labels).collect()
    assert len(rows) == len(edge_rows)
    blank = [r for r in rows if r["log_weight"] is None]
    assert len(blank) == 4 and not any(r["kept"] for r in blank)
    kept = resample(edge, labels, keep_columns=True)
    assert kept.columns == edge.columns
    assert kept.count() == sum(r["kept"] for r in rows)


def test_no_labels_keeps_all(spark, edge, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sum(r["kept"] for r in resample(edge, labels).collect()) == 8
    assert resample(empty, labels).collect() == []
    assert resample(empty, labels, keep_columns=True).collect() == []


def test_best_cut():
    assert 0.2 < best_cut(np.array([0.5, 0.6]), np.array([0.1, 0.2])) < 0.6
    assert best_cut(np.array([]), np.array([1.0])) == -np.inf

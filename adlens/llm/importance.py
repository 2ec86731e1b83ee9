"""Operator 3, quality classifier by importance resampling.

Two bag models over hashed n-grams (single tokens and neighbouring pairs, in
``BUCKETS`` buckets) are counted: one of the target text, the good rows of a
labelled sample, one of the raw text, every document. A document's log weight
is the mean over its n-grams of log target - log raw probability. Sampling
without replacement in proportion to ``exp(log weight / temperature)`` is done
by Gumbel top-k: noise drawn from a hash of the id is added to each tempered
log weight and the k largest sums are kept.

k is the number of documents whose log weight reaches a cut, which is fitted
on the labelled sample (the cut of best balanced accuracy between its good and
bad ids). For that the sample is split into ``FOLDS`` by a hash of the id, and
each part is weighed by a target model of the others, as a text that the target
model has seen weighs more than one like it that it has not. An id of several
rows counts once, with their mean. The sample is bounded (``sample_rows`` labels, drawn by a hash of
the id) and joined as a broadcast; the raw counts cover all documents. Counts
are summed by Spark by bucket; the finished table of ``BUCKETS`` log ratios is
what is broadcast. The k-th key is found by ranks over a range partitioning.

Defined cases: NULL, empty and blank texts have no n-gram, a NULL log weight,
and are never kept; without any good label that others weigh (there must be two
in different parts), or without any bad one, k is the number of documents that have an n-gram; several labels of one id count as its
worst; rows tie by their place in the input; repeated rows are weighed each
for itself (with the same noise); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from adlens.llm.common import free_name, place_of, prefix_sums, scanned, stored, table
from adlens.llm.words import ODD, WordHash, mix, runs

TOKENS = re.compile(r"\w+|[^\w\s]+")
BUCKETS = 1 << 16
FOLDS = 10
RUN_CHARS = 2_000_000


def gram_buckets(texts: list[str | None], hashes: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """All n-gram buckets of the texts, and how many each text has."""
    found = [TOKENS.findall(t or "") for t in texts]
    sizes = np.array([len(f) for f in found], np.int64)
    h = np.concatenate([hashes.of([w.encode() for w in f]) if f else np.zeros(0, np.uint64) for f in found]) \
        if len(found) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[1:] == owner[:-1]
    pairs = mix(h[:-1] * ODD + h[1:])[inside]
    mask = np.uint64(BUCKETS - 1)
    buckets = np.concatenate([h & mask, pairs & mask]).astype(np.int64)
    return buckets, np.concatenate([owner, owner[1:][inside]])


def _texts(b: pa.RecordBatch, k: int) -> Iterator[tuple[int, list]]:
    at = 0
    for part in runs(b.column(k).to_pylist(), lambda t: len(t or "") + 100, RUN_CHARS):
        yield at, part
        at += len(part)


def gram_counts(docs: DataFrame) -> np.ndarray:
    """Counts by bucket: row 0 of all texts, row 1 + f of the good ones of fold f; ``docs``: text, fold or NULL."""
    names = ["raw", *[f"good{f}" for f in range(FOLDS)]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHash(), np.zeros((1 + FOLDS, BUCKETS), np.int64)
        for b in batches:
            fold = b.column(1).fill_null(-1).to_numpy(zero_copy_only=False)
            for at, texts in _texts(b, 0):
                buckets, owner = gram_buckets(texts, hashes)
                counts[0] += np.bincount(buckets, minlength=BUCKETS)
                of = fold[at:at + len(texts)]
                for f in np.unique(of[of >= 0]).tolist():
                    counts[1 + f] += np.bincount(buckets[(of == f)[owner]], minlength=BUCKETS)
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(c[some]) for c in counts]],
                                         names=["bucket", *names])

    schema = ", ".join(["bucket int", *[f"{c} bigint" for c in names]])
    summed = docs.mapInArrow(run, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    counts = np.zeros((1 + FOLDS, BUCKETS))
    for k, c in enumerate(names):
        counts[k, np.array(summed.column("bucket").to_pylist(), int)] = summed.column(c).to_pylist()
    return counts


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Log target - log raw probability by bucket; ``counts``: raw, target."""
    smooth = counts + 1.0
    p = np.log(smooth / smooth.sum(axis=1, keepdims=True))
    return p[1] - p[0]


def weighed(rows: DataFrame, ratios: np.ndarray, text_col: str, out: str, by: str | None = None) -> DataFrame:
    """``rows`` with their log weight as ``out``; the other columns pass through.

    With ``by``, that column tells each row's row of ``ratios``.
    """
    shared = rows.sparkSession.sparkContext.broadcast(ratios)
    k = rows.columns.index(text_col)
    names = [*rows.columns, out]
    which = rows.columns.index(by) if by else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, lr = WordHash(), shared.value
        for b in batches:
            for at, texts in _texts(b, k):
                buckets, owner = gram_buckets(texts, hashes)
                n = np.bincount(owner, minlength=len(texts))
                part = b.slice(at, len(texts))
                logs = lr[buckets] if which is None else lr[part.column(which).to_numpy()[owner], buckets]
                total = np.bincount(owner, weights=logs, minlength=len(texts))
                weight = pa.array(total / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays([*part.columns, weight], names=names)

    schema = StructType([*rows.schema.fields, StructField(out, DoubleType())])
    return rows.mapInArrow(run, schema)


def labelled_sample(labels: DataFrame, sample_rows: int, id_col: str = "doc_id") -> DataFrame:
    """``_id, _good, _bad, _fold`` of ``sample_rows`` labelled ids at most: quality 1 and not toxic is good."""
    worst = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id")).agg(
        F.min("quality").alias("q"), F.max("toxic").alias("t"))
    rows = worst.where("q is not null").select("_id", ((F.col("q") == 1) & (F.coalesce("t", F.lit(0)) == 0)).alias("_good"),
                                               (F.col("q") == 0).alias("_bad"),
                                               F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("_fold"))
    return rows.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut on the log weight of best balanced accuracy; -inf where one side is empty.

    Between the two weights it may lie, it is as many spreads away from the good
    as from the bad side; the spreads of few rows are drawn towards the common one.
    """
    if not len(good) or not len(bad):
        return -np.inf
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.unique(np.concatenate([good, bad]))
    kept = 1 - np.searchsorted(good, cuts, "left") / len(good)
    gone = np.searchsorted(bad, cuts, "left") / len(bad)
    score = kept + gone
    best = int(score.argmax())
    if not best:
        return float(cuts[0])
    common = (len(good) * good.var() + len(bad) * bad.var()) / (len(good) + len(bad))
    spread = [np.sqrt((len(x) * x.var() + 10 * common) / (len(x) + 10)) for x in (good, bad)]
    share = spread[1] / sum(spread) if sum(spread) > 0 else 0.5
    return float(cuts[best - 1] + (cuts[best] - cuts[best - 1]) * share)


def resample(docs: DataFrame, labels: DataFrame, temperature: float = 0.002, sample_rows: int = 20_000,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text", keep_columns: bool = False
             ) -> DataFrame:
    """``doc_id, log_weight, key, kept`` of every row; with ``keep_columns`` the kept rows of ``docs``."""
    docs = scanned(docs) if keep_columns else docs
    sample = stored(labelled_sample(labels, sample_rows), "dsir-labels")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    counts = gram_counts(texts.join(F.broadcast(sample), "_id", "left").select("_text", F.expr("if(_good, _fold, null)")))
    raw, good = counts[0], counts[1:].sum(axis=0)
    ratios = log_ratios(np.stack([raw, good]))
    row, weight, key = (free_name(docs, x) for x in ("_row", "_weight", "_key"))
    noise = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit(seed)), F.lit(1 << 52))
    gumbel = -F.log(-F.log((noise + 0.5) / float(1 << 52)))

    def keyed(rows: DataFrame) -> DataFrame:
        # where rows are read again, equal keys are told apart by what stays the same: their place
        at = place_of(docs) if keep_columns else F.monotonically_increasing_id()
        return weighed(rows.withColumn(row, at), ratios, text_col, weight).withColumn(
            key, F.col(weight) / temperature + gumbel)

    done = stored(keyed(docs.select(F.col(id_col), F.col(text_col))).drop(text_col), "dsir-weights")

    # the cut, on the labelled sample (bounded), each fold weighed by the good rows of the others
    others = [good - own for own in counts[1:]]
    usable = [f for f, c in enumerate(others) if c.any()]
    apart = texts.join(F.broadcast(sample.where(F.col("_fold").isin(usable))), "_id")
    seen = weighed(apart, np.stack([log_ratios(np.stack([raw, c])) for c in others]), "_text", "w", "_fold").where(
        "w is not null").groupBy("_id", "_good", "_bad").agg(F.avg("w").alias("w")).select("w", "_good", "_bad").toArrow()
    w, is_good, is_bad = (np.array(seen.column(k).to_pylist()) for k in range(3))
    cut = best_cut(w[is_good.astype(bool)], w[is_bad.astype(bool)]) if len(w) else -np.inf

    # the k-th largest key and its row
    scored = done.where(F.col(key).isNotNull()).select(
        (-F.col(key)).alias("k"), F.col(row).alias("r"), (F.col(weight) >= F.lit(cut)).cast("long").alias("over"))
    ranked = stored(prefix_sums(scored, "over", ["k", "r"], name="dsir-ranks"), "dsir-ranked")
    last = ranked.where(F.col("rank") == F.col("total") - 1).select("k", "r").first()
    kept: Column = F.lit(False)
    if last is not None:
        edge, here = F.lit(-last["k"]), last["r"]
        here = F.struct(F.lit(here["file"]).alias("file"), F.lit(here["at"]).alias("at")) if keep_columns else F.lit(here)
        kept = F.coalesce((F.col(key) > edge) | ((F.col(key) == edge) & (F.col(row) <= here)), F.lit(False))
    if keep_columns:  # weighed again in passing, which spares a copy of all texts
        return keyed(docs).where(kept).select(*docs.columns)
    return done.select(F.col(id_col).alias("doc_id"), F.col(weight).alias("log_weight"), F.col(key).alias("key"),
                       kept.alias("kept"))


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with their importance weight against the good ``labels``, and the sample kept."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

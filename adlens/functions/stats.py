"""Exact medians without gathering a column into one task.

``percentile``/``median`` aggregates keep every distinct value of the column
in one final task. Here the values of all requested columns are first counted
by (group, metric, value), so a value that very many rows share is one row.
The counts are range-partitioned on (group, metric, value) and written, with
the number of the partition each row fell into, to the shared scratch folder;
everything below reads that one copy. Each partition is totalled, the totals
(one row for each group, metric and partition) give every partition its
starting rank, and a running count inside it gives each value the ranks it
covers. Only the values that cover a middle rank are kept. The median of an
even count is the mean of the two middle values; missing values are skipped; a
metric without values gives NULL.

Where an approximate median will do, ``sketches`` keeps KLL sketches by group (a few
KB each, whatever the rows), which merge: sketches by month and campaign give the
median over any months (``merged_medians``) without the rows. The default is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.session import fresh_dir


def _middles(df: DataFrame, columns: dict[str, str], group: Sequence[str],
             partitions: int | None) -> DataFrame:
    """``group, k, v, lo, hi``: the values at the middle ranks of each metric."""
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.array(*[F.struct(F.lit(name).alias("k"), F.col(src).cast("double").alias("v"))
                      for src, name in columns.items()])
    counts = (df.select(*group, F.explode(pairs).alias("s")).select(*group, "s.k", "s.v")
              .where(F.col("v").isNotNull())
              .groupBy(*group, "k", "v").agg(F.count(F.lit(1)).alias("cnt")))
    path = fresh_dir(spark, "median-counts")
    (counts.repartitionByRange(n_parts, *group, "k", "v")
     .withColumn("pid", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.parquet(path)
    totals = ranged.groupBy(*group, "k", "pid").agg(F.sum("cnt").alias("part_cnt"))
    metric = Window.partitionBy(*group, "k")
    offsets = totals.select(
        *[F.col(c).alias(f"_{c}") for c in (*group, "k", "pid")],
        F.coalesce(F.sum("part_cnt").over(metric.orderBy("pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        F.sum("part_cnt").over(metric).alias("n"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*group, "k", "pid")]
    inside = Window.partitionBy("pid", *group, "k").orderBy("v").rowsBetween(
        Window.unboundedPreceding, 0)
    ranked = ranged.join(offsets, on).select(
        *group, "k", "pid", "v", "cnt", "offset", "n")
    last = F.col("offset") + F.sum("cnt").over(inside)
    ranked = ranked.withColumn("last", last)
    first = F.col("last") - F.col("cnt")

    def covers(rank):
        return (first <= rank) & (rank < F.col("last"))

    lo, hi = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    return ranked.withColumn("lo", covers(lo)).withColumn("hi", covers(hi)).where("lo or hi")


def _medians(names) -> list:
    def middle(name, which):
        return F.max(F.when((F.col("k") == name) & F.col(which), F.col("v")))

    return [((middle(n, "lo") + middle(n, "hi")) / 2).alias(n) for n in names]


def exact_medians(df: DataFrame, columns: dict[str, str], partitions: int | None = None
                  ) -> DataFrame:
    """One row: for each ``source column → output name``, the exact median."""
    return _middles(df, columns, [], partitions).agg(*_medians(columns.values()))


def grouped_medians(df: DataFrame, group: Sequence[str], columns: dict[str, str],
                    partitions: int | None = None) -> DataFrame:
    """One row per group that has a value: the exact median of each column."""
    return _middles(df, columns, group, partitions).groupBy(*group).agg(*_medians(columns.values()))


def exact_median(df: DataFrame, column: str, name: str | None = None,
                 partitions: int | None = None) -> DataFrame:
    """One row, one column ``name``: the exact median of ``column`` (NULL if none)."""
    return exact_medians(df, {column: name or f"median_{column}"}, partitions)


# -- approximate medians -----------------------------------------------------------------

SKETCH_K = 400  # of the KLL sketches: the rank of a median is off by less than 1%, 99 times in 100


def sketches(df: DataFrame, group: Sequence[str], columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """``group`` and a KLL sketch of each column: one pass, partial sketches merged in the shuffle."""
    return df.groupBy(*group).agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns])


def merged_medians(kept: DataFrame, group: Sequence[str], columns: dict[str, str], k: int = SKETCH_K) -> DataFrame:
    """Approximate medians by ``group`` from ``sketches`` by it and more; NULL without a value."""
    merged = kept.groupBy(*group).agg(*[F.kll_merge_agg_double(c, F.lit(k)).alias(c) for c in columns])
    return merged.select(*group, *[_median_of(F.col(c)).alias(name) for c, name in columns.items()])


def sketched_medians(df: DataFrame, columns: dict[str, str], k: int = SKETCH_K) -> DataFrame:
    """One row: for each ``source column → output name``, the approximate median."""
    kept = df.agg(*[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns])
    return kept.select(*[_median_of(F.col(c)).alias(name) for c, name in columns.items()])


def _median_of(sketch):
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)))

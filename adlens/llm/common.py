"""Helpers shared by the operators of this subpackage.

Every operator first projects its input to the columns it names, so extra
columns, whatever they are called, neither clash nor travel. Lineage is cut
by writing a table below ``spark.checkpoint.dir`` (``stored``), which survives
the loss of any executor.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.session import fresh_dir

# A word is a maximal run of anything but space and \t \n \v \f \r.
WORD = "[^\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
PLACE = "struct<file:bigint,at:bigint>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def place_of(docs: DataFrame) -> Column | None:
    """Where a row of a plain scan stands, as (file, row in it): the same however the scan is cut. None for others."""
    if not docs._jdf.queryExecution().analyzed().children().isEmpty():
        return None
    try:
        meta = docs.metadataColumn("_metadata")
        place = F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("at"))
        return place if docs.select(place).schema else None
    except AnalysisException:  # not a scan of files, or of files without numbered rows
        return None


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` itself where its rows have places; else a stored copy, whose rows have."""
    return docs if place_of(docs) is not None else stored(docs, "scanned")


def place_or_null(docs: DataFrame) -> Column:
    """``place_of``, or NULL of the same type."""
    place = place_of(docs)
    return F.lit(None).cast(PLACE) if place is None else place


def at_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs``, which has to be ``scanned``, joined to ``found`` by the ``_place`` of its rows.

    The place of a row is its file and its number in the file, which the scan gives and
    which depends neither on cores nor on how files are split; so no copy of the rows has
    to be kept. ``docs`` keeps its columns, and those of ``found`` must have other names.
    """
    file, at = free_name(docs, "_file"), free_name(docs, "_at")
    place = place_of(docs)
    placed = docs.select("*", place["file"].alias(file), place["at"].alias(at))
    keyed = found.select(*[c for c in found.columns if c != "_place"], F.col("_place.file").alias("_found_file"),
                         F.col("_place.at").alias("_found_at"))
    both = placed.join(keyed, (F.col(file) == F.col("_found_file")) & (F.col(at) == F.col("_found_at")))
    return both.drop(file, at, "_found_file", "_found_at")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the built-in's fast path."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, value: str, order: Sequence[str],
                group: Iterable[str] = (), name: str = "prefix") -> DataFrame:
    """``df`` (stored) with ``before``, ``rank``, ``total`` and ``rows`` by group.

    ``before`` is the sum of ``value`` over the rows of the group ahead in
    ``order``, ``rank`` their number; ``total`` and ``rows`` are the group's.
    The rows are range-partitioned, so one group or one run of equal keys is
    cut over tasks wherever ``order`` ends in a unique column. Each range
    partition is totalled, the totals (one row for each group and partition)
    are summed up in partition order, and each partition adds its own running
    sums. Partition numbers are stored with the rows, so nothing rests on two
    shuffles cutting alike.
    """
    group = list(group)
    n = shuffle_partitions(df.sparkSession)
    ranged = stored(df.repartitionByRange(n, *group, *order)
                    .withColumn("_part", F.spark_partition_id()), name)
    totals = ranged.groupBy(*group, "_part").agg(
        F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    every = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    ahead = every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = totals.select(
        *group, "_part",
        F.coalesce(F.sum("_sum").over(ahead), zero).alias("_before"),
        F.coalesce(F.sum("_rows").over(ahead), zero).alias("_rank"),
        F.sum("_sum").over(every).alias("total"), F.sum("_rows").over(every).alias("rows"))
    inside = Window.partitionBy("_part", *group).orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(offsets, [*group, "_part"])
            .withColumn("before", F.col("_before") + F.coalesce(F.sum(value).over(running), zero))
            .withColumn("rank", F.col("_rank") + F.row_number().over(inside) - 1)
            .drop("_part", "_before", "_rank"))


__all__ = ["WORD", "UPPER", "LOWER", "table", "stored", "free_name", "text_hash", "PLACE", "place_of", "place_or_null", "scanned",
           "at_rows", "shuffle_partitions", "ascii_lower",
           "word_count", "prefix_sums"]

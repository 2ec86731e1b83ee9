"""Raw ad rows: the all-text CSV source.

Every column is read as text with an explicit schema (no inference), the
missing-value tokens of a CSV reader become NULL, and each row carries a
source-order key so that "keep the first duplicate in file order" is
well-defined on a distributed read. Batch and stream share one reader: the
same schema, the same width check and the same order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adlens.config import RAW_COLUMNS
from adlens.functions import na_to_null
from adlens.session import fresh_dir

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])
CORRUPT = "_corrupt_record"

# name of the struct column that orders raw rows as in the source
SEQ = "_seq"


# where a row came from; with its place there, these order rows as in the source
PLACE = ("_file", "_block")
CSV_SCHEMA = StructType(RAW_SCHEMA.fields + [StructField(CORRUPT, StringType(), True)])
QUOTED = '"[^"]*("|$)'  # a quoted stretch; one that is not closed takes the rest of the line


def scan_csv(reader, path: str, header: bool = True) -> DataFrame:
    """The raw columns as read by ``spark.read`` or ``spark.readStream``, with the row's place."""
    return (reader.schema(CSV_SCHEMA)
            .option("header", header)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path)
            .select("*", F.col("_metadata.file_path").alias(PLACE[0]),
                    F.col("_metadata.file_block_start").alias(PLACE[1])))


def checked_width(df: DataFrame) -> DataFrame:
    """Stop on a row with more fields than the header; the reader would cut it silently.

    A row with fewer fields is padded with NULL (rule 1 then rejects it by
    name, where a shift put another value in the campaign's place). Only rows
    that the reader marks as malformed are counted.
    """
    plain = F.regexp_replace(CORRUPT, QUOTED, "")  # separators outside quotes, in one pass
    fields = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    # the reader wants another column read beside this one, also by a plain count
    beside = F.length(F.coalesce(RAW_COLUMNS[0], F.lit(""))) >= 0
    too_wide = F.col(CORRUPT).isNotNull() & (fields > len(RAW_COLUMNS)) & beside
    kept = F.when(~too_wide, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("malformed raw row: "), F.col(CORRUPT))))
    return df.where(kept).drop(CORRUPT)


def raw_rows(scanned: DataFrame, check_width: bool = True) -> DataFrame:
    """Raw rows of ``scan_csv``'s result (of a micro-batch, on a stream), NA tokens as NULL.

    ``_seq`` orders rows as in the files: path, split start, then the row's
    position inside its split.
    """
    df = checked_width(scanned) if check_width else scanned.drop(CORRUPT)
    seq = F.struct(F.col(PLACE[0]).alias("file"), F.col(PLACE[1]).alias("block"),
                   F.monotonically_increasing_id().alias("pos"))
    return normalize_raw(df.withColumn(SEQ, seq).drop(*PLACE))


def read_raw_csv(spark: SparkSession, path: str, check_width: bool = True) -> DataFrame:
    """Raw ad rows from CSV text; all columns stay text. A lazy scan."""
    return raw_rows(scan_csv(spark.read, path), check_width)


def land_raw(raw: DataFrame, partitions: int | None = None) -> DataFrame:
    """Raw rows written once as Parquet in the shared work folder, and read back.

    Validation reads the raw rows more than once and needs few of their
    columns; a landed copy is parsed once and read by column. Where ``_seq`` is
    the place in CSV files it becomes one number, so that the first row of a
    key is found by a hash aggregation: splits are numbered in source order (a
    row for each split), and rows by their place within. ``partitions`` deals the
    rows anew, for a source that is a single unsplittable file.
    """
    spark = raw.sparkSession
    if partitions:
        raw = raw.repartition(partitions)
    path = fresh_dir(spark, "raw-landed")
    raw.write.parquet(path)
    landed = spark.read.schema(raw.schema).parquet(path)
    kind = raw.schema[SEQ].dataType
    if not (isinstance(kind, StructType) and kind.fieldNames() == ["file", "block", "pos"]):
        return landed
    splits = landed.select(f"{SEQ}.file", f"{SEQ}.block").distinct()
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("file", "block"))
    order_path = fresh_dir(spark, "raw-splits")
    splits.select("file", "block", number.cast("long").alias("_split")).write.parquet(order_path)
    numbered = spark.read.parquet(order_path)
    within = F.col(f"{SEQ}.pos").bitwiseAND(F.lit((1 << 33) - 1))
    return (landed.join(numbered, (F.col(f"{SEQ}.file") == numbered["file"])
                        & (F.col(f"{SEQ}.block") == numbered["block"]))
            .select(*RAW_COLUMNS, (F.shiftleft(F.col("_split"), 33) + within).alias(SEQ)))


def normalize_raw(df: DataFrame) -> DataFrame:
    """Missing-value tokens to NULL on every raw column."""
    return df.select(*[na_to_null(c).alias(c) for c in RAW_COLUMNS],
                     *[c for c in df.columns if c not in RAW_COLUMNS])

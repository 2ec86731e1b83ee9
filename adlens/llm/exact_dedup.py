"""Operator 8, exact dedup by content-defined chunk recipes.

Each normalised text is cut into chunks where its content says so: after a
newline or a sentence end, once a chunk has ``MIN_CHUNK`` characters, and at
``MAX_CHUNK`` at the latest. A cut depends on the characters before it only,
so equal texts have equal chunks.

Each chunk is sent once to the task that owns its hash (partial distinct
first, so a chunk in a third of all documents leaves each task once). There
its content is compared: chunks with equal hash and other content get
different ranks, which makes (hash, rank) a verified identifier. A document
is then its recipe, the ordered list of identifiers, and equal recipes mean
equal texts. Only the short recipes are grouped and joined; documents are
never moved. The group join is an equi-join that adaptive execution may split
where one text holds a third of all rows.

Defined cases: NULL text counts as empty, and all empty texts form one group
(empty recipe); of rows with equal text the largest id stays, NULL ids losing
to any other; of repeated rows with that id exactly one stays; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import ascii_lower, place_or_null, stored, table

MIN_CHUNK, MAX_CHUNK = 256, 4096
LEAST = -(2 ** 63)


def chunks(text: Column) -> Column:
    """The text's chunks in order; together they are the whole text."""
    pattern = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?:(?<=[\\n.])|(?=\\z))|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``_row, _place, doc_id, recipe, text_sha256`` with verified chunk identifiers."""
    norm = docs.select(F.monotonically_increasing_id().alias("_row"), place_or_null(docs).alias("_place"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("norm"))
    cut = norm.select("_row", "_place", "doc_id", F.sha2("norm", 256).alias("text_sha256"),
                      chunks(F.col("norm")).alias("chunks"))
    owned = (norm.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
             .select(hash_of(F.col("chunk")).alias("h"), "chunk").distinct())
    # contents that share their hash with another content: none, but for a collision
    shared = stored(owned.groupBy("h").count().where("count > 1").select("h"), "dedup-shared")
    plain = cut.withColumn("recipe", F.transform("chunks", lambda c: F.struct(
        hash_of(c).alias("h"), F.lit(0).alias("rank")))).drop("chunks")
    if shared.isEmpty():
        return plain
    cut = stored(cut, "dedup-chunks")
    by_content = Window.partitionBy("h").orderBy("chunk")
    ranks = (owned.join(shared, "h")
             .select("h", "chunk", F.row_number().over(by_content).alias("rank")))
    pieces = (cut.select("_row", F.posexplode("chunks").alias("at", "chunk"))
              .withColumn("h", hash_of(F.col("chunk")))
              .join(ranks, ["h", "chunk"], "left")
              .select("_row", F.struct("at", "h", F.coalesce("rank", F.lit(0)).alias("rank")).alias("piece")))
    lists = pieces.groupBy("_row").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    exact = F.transform(F.coalesce("pieces", F.array().cast("array<struct<at:int,h:bigint,rank:int>>")),
                        lambda p: F.struct(p["h"].alias("h"), p["rank"].alias("rank")))
    return (cut.drop("chunks").join(lists, "_row", "left")
            .select("_row", "_place", "doc_id", "text_sha256", exact.alias("recipe")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: ``_row, _place, doc_id, keep_id, group_size, kept, text_sha256``.

    ``_place`` leads back to the input (``common.at_rows``).
    """
    listed = stored(recipes(docs, id_col, text_col, hash_of), "dedup-recipes")
    place = F.coalesce("doc_id", F.lit(LEAST))
    groups = listed.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.max_by("_row", place).alias("_keep"),
        F.count(F.lit(1)).alias("group_size"))
    groups = stored(groups, "dedup-groups")
    return listed.join(groups, "recipe").select(
        "_row", "_place", "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep")).alias("kept"),
        "text_sha256")


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, dropped ones too, with the document that stays of each text."""
    return exact_dedup(table(spark, sf_dir, "documents")).drop("_row", "_place")


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

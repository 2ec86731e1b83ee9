"""Operator 1, sharding: contiguous shards of near equal bytes.

Rows are put in order of their id; a global prefix sum of their sizes, built
from the totals of range partitions, gives each row its byte offset, and the
line of all bytes is cut at ``n_shards`` equal targets. A row belongs to the
shard in which it starts, so each shard is a contiguous run of rows and its
bytes miss the target by less than its last row.

Defined cases: a NULL text has no bytes (size 1, CRC 0, as the empty text); a
NULL id sorts first; repeated rows and equal ids are separate rows, ordered
by size, CRC and place in the input; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import prefix_sums, stored


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``; ``slot`` counts from 0 in each shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"))
    placed = prefix_sums(rows, "size", ["doc_id", "size", "text_crc32", "_row"], name="shard")
    shard = F.expr(f"cast((before * {int(n_shards)}) div total as int)")
    placed = stored(placed.select("doc_id", "size", "text_crc32", "rank", shard.alias("shard")),
                    "shard-placed")
    # one row a shard: its first rank
    first = placed.groupBy("shard").agg(F.min("rank").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("_first")).alias("slot"))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 8 shards by the ``bytes`` law."""
    from adlens.llm.common import table

    out = shard_by_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))

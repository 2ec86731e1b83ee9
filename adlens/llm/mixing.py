"""Operator 4, mixing sources to target weights over packed blocks.

The words of each source, in order of document id, are packed end to end and
cut into blocks of ``block_words`` (the last may be short); a source of few words has
smaller blocks, ``LEAST_BLOCKS`` or more. A source's target decides how many slots of
the mix it fills: the blocks times target / size, the part of a slot that is left
over decided by a hash of the source. The output is cut into shards of ``shard_slots``
slots. Each shard's source counts are drawn: one pseudorandom permutation deals all
slots over the output, which is a multinomial draw for every shard, conditioned on the
totals that the targets ask for. The drawn counts, summed up over the shards ahead,
number a source's slots from 0 on. Slot ``j`` of a source uses, in its pass ``j div n``
over the source's ``n`` blocks, the block that a permutation of its own gives for
``j mod n``: no block is used again before all were, and blocks and slots meet in an
equi-join by index.

Targets: sources in code point order (NULL last) weigh 1, 2, 3, repeating, and
share all words; a target stops at ``max_passes`` times its source's size and
the excess is shared again by weight. That is a water level: targets are
``min(cap, level * weight)``, found from sums over the sources in order of
cap/weight. Sums over rows or sources go through ``prefix_sums``, so neither a
hot source nor the list of sources gathers in one task.

Defined cases: a NULL or blank text has size 0 and nothing is taken; NULL is a
source of its own; repeated rows and equal ids are separate documents; where no
document has a word all targets are 0; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import (
    at_rows,
    free_name,
    place_or_null,
    prefix_sums,
    scanned,
    shuffle_partitions,
    stored,
    table,
    word_count,
)

SOURCE = ["_null", "_src"]
CHUNK = 4096  # slots written out by one row
LEAST_BLOCKS = 64  # of a source, where it has so many words


def block_size(words: Column, block_words: int) -> Column:
    """Words of a block of a source of so many ``words``."""
    return F.least(F.lit(int(block_words)), F.greatest(F.lit(1), F.floor(words / LEAST_BLOCKS))).cast("long")


def permute(i: Column, n: Column, *key: Column, rounds: int = 24) -> Column:
    """Place of ``i`` in a pseudorandom permutation of 0..n-1 that ``key`` picks.

    Swap-or-not rounds: each pairs x with k - x (mod n) and swaps the pair by
    the hash of its larger member, which is a permutation for every n.
    """
    def swap(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        swaps = F.xxhash64(*key, r, F.greatest(x, mirror)).bitwiseAND(F.lit(1)) == 1
        return F.when(swaps, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), i, swap)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   max_passes: int = 3) -> DataFrame:
    """``_null, _src, size`` with ``target`` (double) added, one row a source."""
    index = prefix_sums(sizes, "size", SOURCE, name="mix-index")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    caps = index.select(*SOURCE, "size", F.col("total").alias("all_words"), weight.alias("weight"),
                        (F.col("size") * max_passes).alias("cap"))
    caps = stored(caps.withColumn("ratio", F.col("cap") / F.col("weight")), "mix-caps")
    # the capped sources are the first ones in order of cap/weight
    order = ["ratio", *SOURCE]
    capped_before = prefix_sums(caps, "cap", order, name="mix-level").select(
        *SOURCE, F.col("before").alias("cap_before"))
    ahead = prefix_sums(caps, "weight", order, name="mix-level")
    level = ((F.col("all_words") - F.col("cap_before")).cast("double")
             / (F.col("total") - F.col("before")))
    levels = ahead.join(capped_before, SOURCE).withColumn("level", level)
    free = levels.where(F.col("level") * F.col("weight") <= F.col("cap")).agg(
        F.min_by("level", "rank").alias("level"))
    return stored(caps.crossJoin(F.broadcast(free)).select(
        *SOURCE, "size",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")),
        "mix-targets")


def shard_counts(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """The draw: ``shard, _null, _src, blocks, count``, a row for each source that a shard has slots of."""
    blocks = F.ceil(F.col("size") / block_size(F.col("size"), block_words)).cast("long")
    chance = (F.pmod(F.xxhash64(F.lit("slots"), F.lit(seed), *map(F.col, SOURCE)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    wanted = targets.where("size > 0").withColumn("blocks", blocks).withColumn(
        "wanted", F.col("blocks") * F.col("target") / F.col("size"))
    slots = F.floor("wanted") + (chance < F.col("wanted") - F.floor("wanted")).cast("long")
    counts = (prefix_sums(wanted.withColumn("slots", slots.cast("long")), "slots", SOURCE, name="mix-slots")
              .where("slots > 0")
              .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CHUNK})"))))
    spread = counts.repartition(shuffle_partitions(targets.sparkSession), *SOURCE, "chunk")
    j = F.explode(F.expr(f"sequence(chunk * {CHUNK}, least((chunk + 1) * {CHUNK}, slots) - 1)"))
    at = permute(F.col("before") + F.col("j"), F.col("total"), F.lit(seed))
    return (spread.withColumn("j", j).withColumn("at", at)
            .groupBy(F.expr(f"at div {int(shard_slots)}").alias("shard"), *SOURCE, "blocks")
            .agg(F.count(F.lit(1)).alias("count")))


def mix_slots(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """The mix: one row per slot, ``shard, _null, _src, pass, block``, from each shard's drawn counts."""
    drawn = prefix_sums(shard_counts(targets, block_words, shard_slots, seed), "count", ["shard"], SOURCE, "mix-shards")
    # a few short rows, each of which becomes up to shard_slots ones: dealt out ahead of that
    drawn = drawn.repartition(shuffle_partitions(targets.sparkSession), *SOURCE, "shard")
    j = F.explode(F.expr("sequence(before, before + count - 1)"))
    pick = permute(F.col("j") % F.col("blocks"), F.col("blocks"), F.lit(seed), *map(F.col, SOURCE), F.col("pass"))
    return (drawn.withColumn("j", j).withColumn("pass", F.expr("j div blocks"))
            .select("shard", *SOURCE, "pass", pick.alias("block")))


def placed_documents(docs: DataFrame, source_col: str, id_col: str, text_col: str) -> DataFrame:
    """``_row, _place, doc_id, _null, _src, size, before, total``: places in the packed source (stored)."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), place_or_null(docs).alias("_place"),
        F.col(id_col).alias("doc_id"), F.col(source_col).isNull().alias("_null"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_src"),
        word_count(F.col(text_col)).alias("size"))
    return stored(prefix_sums(rows, "size", ["doc_id", "_row"], SOURCE, "mix-placed")
                  .drop("rank", "rows"), "mix-documents")


def plan(placed: DataFrame, weights: tuple[int, ...], max_passes: int, block_words: int,
         shard_slots: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The sources' targets and the slots of the mix."""
    sizes = placed.groupBy(*SOURCE).agg(F.sum("size").alias("size"))
    targets = source_targets(sizes, weights, max_passes)
    return targets, mix_slots(targets, block_words, shard_slots, seed)


def pieces_of(placed: DataFrame, block_words: int) -> DataFrame:
    """Each document's part of each block: ``_row, _null, _src, block, first, words``.

    ``first`` is the part's first word within the document.
    """
    sized = placed.where("size > 0").withColumn("_b", block_size(F.col("total"), block_words))
    pieces = sized.withColumn("block", F.explode(F.expr("sequence(before div _b, (before + size - 1) div _b)")))
    return (pieces.withColumn("first", F.greatest(F.col("block") * F.col("_b") - F.col("before"), F.lit(0)))
            .withColumn("words", F.least((F.col("block") + 1) * F.col("_b") - F.col("before"), F.col("size"))
                        - F.col("first")).drop("_b"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = 3,
                block_words: int = 64, shard_slots: int = 4096, seed: int = 7,
                source_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
                ) -> DataFrame:
    """What the mix takes: ``doc_id, size, source_size, target, taken``, a row per document."""
    placed = placed_documents(docs, source_col, id_col, text_col)
    targets, slots = plan(placed, weights, max_passes, block_words, shard_slots, seed)
    # slots and blocks grow with the data, though they come out of a few rows of
    # targets: Spark would take them for small and broadcast them
    uses = slots.groupBy(*SOURCE, "block").agg(F.count(F.lit(1)).alias("uses")).hint("merge")
    taken = (pieces_of(placed, block_words).join(uses, [*SOURCE, "block"])
             .groupBy("_row").agg(F.sum(F.col("uses") * F.col("words")).alias("taken")))
    return (placed.join(targets.select(*SOURCE, "target"), SOURCE).join(taken.hint("merge"), "_row", "left")
            .select("doc_id", "size", F.col("total").alias("source_size"), "target",
                    F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_passes: int = 3,
                    block_words: int = 64, shard_slots: int = 4096, seed: int = 7,
                    source_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
                    ) -> DataFrame:
    """The mix as documents: for each pass a row with the words taken in it, in order.

    A document of which a pass takes every block keeps its text as it is; of
    another the parts of its taken blocks remain, with the white space that
    follows each word. Rows keep the columns of ``docs``; documents of which
    nothing is taken go.
    """
    docs = scanned(docs)
    placed = placed_documents(docs, source_col, id_col, text_col)
    _, slots = plan(placed, weights, max_passes, block_words, shard_slots, seed)
    parts, turn = free_name(docs, "_parts"), free_name(docs, "_pass")
    taken = (pieces_of(placed, block_words)
             .join(slots.select(*SOURCE, "block", "pass").hint("merge"), [*SOURCE, "block"])
             .groupBy("_row", "_place", "pass", "size")
             .agg(F.sort_array(F.collect_list(F.struct("first", "words"))).alias("parts"), F.sum("words").alias("n")))
    taken = taken.select("_place", F.col("pass").alias(turn),
                         F.when(F.col("n") < F.col("size"), F.col("parts")).alias(parts))
    # a word with the white space ahead of it
    words = F.regexp_extract_all(F.col(text_col), F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    # the words are bound once: inside the inner function they would be looked up again for every part
    cut = F.get(F.transform(F.array(words), lambda all_words: F.concat_ws("", F.flatten(F.transform(
        parts, lambda p: F.slice(all_words, (p["first"] + 1).cast("int"), p["words"].cast("int")))))), F.lit(0))
    text = F.when(F.col(parts).isNull(), F.col(text_col)).otherwise(cut)
    return at_rows(docs, taken).select(
        *[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of each of the ``documents``."""
    return mix_sources(table(spark, sf_dir, "documents"))

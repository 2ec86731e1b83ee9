"""Operator 9, chat formatting by quotation linking.

A message is parsed into blocks of lines of one quote level (the number of
leading ``>`` marks); blank lines and changes of level end a block. Level 0 is
the author's own text, level 1 what is quoted, level 2 what that quoted. Each
block, and each line of a longer block, is normalised (lower case, single
spaces) and hashed to 128 bits, alone and with what it answers: the nearest
block one level deeper, with that block's own, and so on (1, 2, 4, ... levels
deep). The blocks of a level are also taken together. Quoted passages are
joined to messages that have the passage as own text, by each of these hashes;
the deepest that matches counts, so a text that many messages share links to
the one that answered the same. A quote links to one original of a hash, the
nearest ahead of the quoting message. Where a hash has one original, that is a
join; where it has more, originals and quotes are ordered by hash and time over a range
partitioning, which cuts a hash that very many messages share, and each takes the last
original before it, from its own partition or carried over from those ahead. Of a
message's links those of the lowest level win, then the original with the most
quoted words in whole blocks, then in single lines, then the nearest: that is its
parent, always an earlier message.

Parents make trees. Roots and depths come from pointer doubling, which needs
the logarithm of the deepest thread in rounds; the order within each
conversation comes from a range partitioning, so a conversation that holds a
third of all messages is never gathered in one task. The result is one row per
message: its conversation, its place in reply order (a message after the one
it answers, level by level), and its own text without quotes and without the
line that introduces them.

Defined cases: NULL and empty texts have no passages and stand alone; a quote
of nothing known leaves the message a root; messages with NULL id link with
nothing; repeated rows and equal ids are messages of their own, and quotes of
them link to one of them; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import prefix_sums, shuffle_partitions, stored, table

MARKS = re.compile(r"(?: ?>)+ ?")
# How the line ahead of a quote ends.
INTRODUCTIONS = ("wrote:", "writes:", "schrieb:", "a écrit :", "escribió:")
MIN_LINE_WORDS = 3

PASSAGE = pa.struct([("level", pa.int32()), ("whole", pa.bool_()), ("words", pa.int64()),
                     ("keys", pa.list_(pa.binary()))])
PARSED = ("_row bigint, own string, passages array<struct<level:int, whole:boolean, words:bigint, keys:array<binary>>>")
NOTHING = bytes(16)  # stands for what a text answers that quotes nothing


def blocks(text: str) -> list[tuple[int, list[str]]]:
    """(level, lines) of the text's blocks in order; no blank lines, no quote marks."""
    out: list[tuple[int, list[str]]] = []
    last = None
    for line in text.split("\n"):
        m = MARKS.match(line)
        level = m.group().count(">") if m else 0
        body = (line[m.end():] if m else line).rstrip()
        if level > 0 and last == 0 and out[-1][1][-1].strip().lower().endswith(INTRODUCTIONS):
            out[-1][1].pop()
            if not out[-1][1]:
                out.pop()
        if not body.strip():
            # an introduction stays the last line until a quote or a text follows
            last = 0 if last == 0 and out and out[-1][0] == 0 and out[-1][1][-1].strip().lower().endswith(
                INTRODUCTIONS) and not level else None
            continue
        if last == level and out:
            out[-1][1].append(body)
        else:
            out.append((level, [body]))
        last = level
    return out


def text_words(lines: list[str]) -> list[str]:
    return " ".join(lines).lower().split()


def words_hash(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).encode())


def passage(level: int, whole: bool, words: list[str], answers: list[bytes]) -> dict:
    """``keys``: the hash of the words, then with what they answer, ever deeper."""
    alone = words_hash(words)
    return {"level": level, "whole": whole, "words": len(words),
            "keys": [alone, *[xxhash.xxh3_128_digest(alone + x) for x in answers]]}


def chain(at: int | None, deeper: dict[int, int], hashes: dict[int, bytes]) -> list[bytes]:
    """Hashes of what stands at ``at`` and ``deeper`` from there, over 1, 2, 4, ... steps."""
    if at is None:
        return [NOTHING]
    out, so_far, steps = [], b"", 0
    while at is not None:
        so_far, steps = xxhash.xxh3_128_digest(so_far + hashes[at]), steps + 1
        if steps & (steps - 1) == 0:
            out.append(so_far)
        at = deeper.get(at)
    return out


def answered(levels: list[int]) -> dict[int, int]:
    """For each block the nearest one a level deeper: the last ahead of it, else the first behind it."""
    out: dict[int, int] = {}
    for order in (range(len(levels)), range(len(levels) - 1, -1, -1)):
        last: dict[int, int] = {}
        for k in order:
            if levels[k] + 1 in last:
                out.setdefault(k, last[levels[k] + 1])
            last[levels[k]] = k
    return out


def parse(text: str | None) -> tuple[str, list[dict]]:
    """The own text and the passages of all levels."""
    own, found, parts = [], [], blocks(text or "")
    deeper = answered([level for level, _ in parts])
    words = [text_words(lines) for _, lines in parts]
    hashes = {k: words_hash(w) for k, w in enumerate(words)}
    together: dict[int, list[int]] = {}
    for k, (level, lines) in enumerate(parts):
        if level == 0:
            own.append("\n".join(lines))
        together.setdefault(level, []).append(k)
        answers = chain(deeper.get(k), deeper, hashes)
        found.append(passage(level, True, words[k], answers))
        if len(lines) > 1:
            single = [passage(level, False, text_words([x]), answers) for x in lines]
            found.extend(p for p in single if p["words"] >= MIN_LINE_WORDS)
    joined = {level: [w for k in at for w in words[k]] for level, at in together.items()}
    hashes, deeper = {n: words_hash(w) for n, w in joined.items()}, {n: n + 1 for n in joined if n + 1 in joined}
    for level, at in together.items():  # a level of several blocks, or that answers several
        if len(at) > 1 or len(together.get(level + 1, ())) > 1:
            found.append(passage(level, True, joined[level], chain(deeper.get(level), deeper, hashes)))
    return "\n\n".join(own), found


def parsed(messages: DataFrame) -> DataFrame:
    """``_row, own, passages`` of ``_row, text``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [parse(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in rows], pa.string()),
                 pa.array([p for _, p in rows], pa.list_(PASSAGE))], names=["_row", "own", "passages"])

    return messages.mapInArrow(run, PARSED)


def nearest_ahead(originals: DataFrame, quotes: DataFrame) -> DataFrame:
    """``quotes`` with ``parent, parent_id``: the last original of the same key with a smaller id.

    ``originals``: key, id, _row; ``quotes``: key, id and others. Quotes without one go.
    """
    own = [c for c in quotes.columns if c not in ("key", "id")]
    held = originals.select("key", "id", F.struct("id", "_row").alias("o"))
    asked = quotes.select("key", "id", F.struct(*own).alias("q"))
    both = asked.unionByName(held, allowMissingColumns=True).withColumn("is_original", F.col("o").isNotNull())
    order = ["id", "is_original"]  # of one id, quotes come first: an original has to be earlier
    ranged = stored(both.repartitionByRange(shuffle_partitions(quotes.sparkSession), "key", *order, F.xxhash64("o", "q"))
                    .withColumn("_part", F.spark_partition_id()), "quote-ranged")
    ahead = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranged.groupBy("key", "_part").agg(F.max("o").alias("last")).select(
        "key", "_part", F.max("last").over(ahead).alias("carried"))
    inside = Window.partitionBy("_part", "key").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("before", F.max("o").over(inside)).where("not is_original").join(carried, ["key", "_part"])
    link = F.coalesce("before", "carried")
    return found.withColumn("link", link).where("link is not null").select(
        "key", "id", "q.*", F.col("link._row").alias("parent"), F.col("link.id").alias("parent_id"))


def parents(read: DataFrame) -> DataFrame:
    """``_row, parent, parent_id`` of messages that quote an earlier one; ``read``: _row, id, passages."""
    one = read.select("_row", "id", F.posexplode("passages").alias("n", "p")).select("_row", "id", "n", "p.*")
    one = one.select("*", F.posexplode("keys").alias("depth", "key")).drop("keys")
    held = one.where("level = 0 and id is not null").select("key", "id", "_row")
    originals = held.groupBy("key").agg(
        F.min("id").alias("parent_id"), F.min_by("_row", "id").alias("parent"), F.count(F.lit(1)).alias("times"))
    quotes = one.where("level > 0 and id is not null").join(originals, "key").where("parent_id < id")
    quotes = stored(quotes, "quote-candidates")
    single = quotes.where("times = 1").drop("times", "key")
    shared = quotes.where("times > 1")
    several = held.join(shared.select("key").distinct(), "key", "left_semi")
    links = single.unionByName(nearest_ahead(several, shared.drop("times", "parent", "parent_id")).drop("key"))
    found = F.struct("level", "whole", "words", "parent", "parent_id")
    links = links.groupBy("_row", "n").agg(F.max_by(found, "depth").alias("l")).select("_row", "l.*")
    each = links.groupBy("_row", "level", "parent", "parent_id").agg(
        F.sum(F.when(F.col("whole"), F.col("words")).otherwise(0)).alias("in_blocks"), F.sum("words").alias("in_all"))
    rank = F.struct(-F.col("level"), "in_blocks", "in_all", "parent_id", "parent")
    return each.groupBy("_row").agg(F.max_by(F.struct("parent", "parent_id"), rank).alias("p")).select("_row", "p.*")


def roots(tree: DataFrame) -> DataFrame:
    """``_row, root, depth`` of every row that has a parent; ``tree``: _row, parent.

    Pointers double: a row whose pointer has not reached a root takes on its
    target's pointer. Rows that have arrived take no part in later rounds.
    """
    target = tree.select(F.col("_row").alias("parent"), F.lit(True).alias("inner"))
    at = stored(tree.select("_row", "parent").join(target, "parent", "left").select(
        "_row", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"),
        F.col("inner").isNull().alias("done")), "quote-roots")
    while not (pending := at.where("not done")).isEmpty():
        up = at.select(F.col("_row").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"),
                       F.col("done").alias("arrived"))
        moved = pending.join(up, "root").select(
            "_row", F.col("above").alias("root"), (F.col("depth") + F.col("more")).alias("depth"),
            F.col("arrived").alias("done"))
        at = stored(at.where("done").unionByName(moved), "quote-roots")
    return at.drop("done")


def link_quotations(messages: DataFrame, id_col: str = "msg_id", role_col: str = "role", text_col: str = "text"
                    ) -> DataFrame:
    """One row per message: ``conversation_id, position, msg_id, parent_id, depth, role, text``.

    ``conversation_id`` is the id of the conversation's first message and
    ``position`` counts from 0; ``text`` is the own text. Ids order messages
    in time.
    """
    rows = stored(messages.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("id"),
                                  F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text")),
                  "quote-messages")
    read = stored(parsed(rows.select("_row", "text")).join(rows.drop("text"), "_row"), "quote-parsed")
    tree = stored(parents(read.select("_row", "id", "passages")), "quote-links")
    placed = read.drop("passages").join(tree, "_row", "left").join(roots(tree), "_row", "left").select(
        "_row", "id", "role", "own", "parent_id", F.coalesce("root", "_row").alias("root"),
        F.coalesce("depth", F.lit(0).cast("long")).alias("depth"), F.lit(1).cast("long").alias("one"))
    first = read.select(F.col("_row").alias("root"), F.col("id").alias("conversation_id"))
    ordered = prefix_sums(placed, "one", ["depth", "id", "_row"], ["root"], "quote-order")
    return ordered.join(first, "root").select(
        "conversation_id", F.col("rank").alias("position"), F.col("id").alias("msg_id"), "parent_id", "depth", "role",
        F.col("own").alias("text"))


def mails(conversations: DataFrame) -> DataFrame:
    """Stand-in input: each turn as a mail that quotes the turn before it, which quotes the one before that."""
    def quoted(text, marks):
        return F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks), F.lit("\n"))

    turns = conversations.select("conv_id", "turn", "role", "text")
    earlier = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    for back in (1, 2):
        ahead = earlier.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("said").alias(f"said{back}"))
        turns = turns.join(ahead, ["conv_id", "turn"], "left")
    body = F.concat_ws("", quoted(F.col("said2"), "> > "), quoted(F.col("said1"), "> "), F.col("text"))
    return turns.select((F.col("conv_id") * 1_000_000 + F.col("turn")).alias("msg_id"), "role", body.alias("text"))


def op9_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` as quoting mails, linked back into reply-ordered conversations."""
    return link_quotations(mails(table(spark, sf_dir, "conversations")))

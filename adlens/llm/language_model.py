"""Operator 7, LM scoring by a hierarchical Pitman-Yor bigram model.

Each context (the previous token; a text's first token follows an end) is a
Chinese restaurant, whose customers are the training tokens that followed it
and whose tables each serve one word. The tables of all contexts are the
customers of one parent restaurant, whose base is uniform over the training
vocabulary and one unknown word. A Gibbs sweep samples, for every context and
word, the number of tables its customers sit at, given the parent's
probability of the word and the context's number of tables (a block for each
dish, by generalised Stirling numbers; by seating in leaps for dishes of more
than ``EXACT`` customers), then the parent's tables. Sweeps after the first use
the state of the sweep before for what is held fixed; the first uses unigram
estimates. ``samples`` seatings are drawn in the last sweep, and a token's
probability is the mean of their predictive probabilities.

All counts cover all training tokens. Texts are tokenised once into chunks of
about ``CHUNK_WORDS`` tokens, stored in the shared folder. From then on chunks
and buckets exchange arrays: a chunk sends each distinct word, and each
distinct pair of context and word, once to the bucket its hash picks, with its
count; the buckets add up, sample and answer in the order asked. A word or
pair that makes up a third of all tokens is therefore one entry for each chunk,
and a frequent context is spread over all buckets by its words. The number of
buckets follows the number of tokens, so each task holds a bounded piece.
Word hashes have 64 bits; in pairs, and in the parent, their upper 32. Words that agree
in these (one in a thousand at four million words) are one word to the model: they
share a restaurant, its customers and its seating, and each has their common
probability, which thus never passes 1. The counts behind ``base_score`` stay apart.

Defined cases: NULL text is empty, and an empty text is one end token; a NULL
id counts as an empty one in the fold; without training tokens N and V are 0
and the model is the uniform base; repeated rows are scored and counted each
for itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import math
import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored, table
from adlens.llm.language_id import fold
from adlens.llm.words import WordHash, mix, runs, words_of

CHUNK_WORDS = 2_000_000
BUCKET_TOKENS = 2_000_000
EXACT = 1024
DISCOUNT, STRENGTH = 0.8, 1.0  # of the context restaurants
ROOT_DISCOUNT, ROOT_STRENGTH = 0.6, 1.0
END = b""  # no word is empty

CHUNKS = ("chunk bigint, doc_id array<bigint>, held array<boolean>, lengths array<bigint>, end int, "
          "high binary, low binary, counts binary, tokens binary, ranks binary")
MESSAGES = "dest bigint, chunk bigint, kind int, a binary, b binary, c binary"


def pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x).tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def pack_planes(x: np.ndarray) -> bytes:
    """Packed with the first bytes of all numbers ahead, then the second ones, and so on."""
    return pack(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T)


def unpack_planes(b: bytes, dtype) -> np.ndarray:
    planes = unpack(b, np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_ascending(x: np.ndarray) -> bytes:
    """Packed steps of an ascending array of numbers below 2^32."""
    return pack_planes(np.diff(x.astype(np.uint64), prepend=np.uint64(0)).astype(np.uint32))


def unpack_ascending(b: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(b, np.uint32).astype(np.uint64), dtype=np.uint64)


def message_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)],
                    names=["dest", "chunk", "kind", "a", "b", "c"])


# -- chunks -----------------------------------------------------------------------

def tokenised(docs: DataFrame) -> DataFrame:
    """Chunks of ``doc_id, held, text``: their distinct words, training counts and tokens.

    Words are in order of their hash, stored as upper (``high``) and lower
    halves; tokens are places in the order of the words' frequency, which packs
    well, and ``ranks`` leads back.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        hashes, made = WordHash(), 0
        first = TaskContext.get().partitionId() << 32
        rows = ((d, h, t) for b in batches for d, h, t in
                zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
        lists = ((d, h, hashes.of([*words_of(t), END])) for d, h, t in rows)
        for part in runs(lists, lambda x: len(x[2]), CHUNK_WORDS):
            lengths = np.array([len(x) for _, _, x in part])
            words, at = np.unique(np.concatenate([x for _, _, x in part]), return_inverse=True)
            train = np.repeat([not h for _, h, _ in part], lengths)
            counts = np.bincount(at[train], minlength=len(words)).astype(np.int32)
            ranks = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")
            place = np.empty(len(words), np.uint32)
            place[ranks] = np.arange(len(words))
            end = int(np.searchsorted(words, np.uint64(xxhash.xxh3_64_intdigest(END))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), pa.array([[d for d, _, _ in part]], pa.list_(pa.int64())),
                 pa.array([[h for _, h, _ in part]], pa.list_(pa.bool_())),
                 pa.array([lengths.tolist()], pa.list_(pa.int64())), pa.array([end], pa.int32()),
                 *[pa.array([x], pa.binary()) for x in (
                     pack_ascending(words >> np.uint64(32)), words.astype(np.uint32).tobytes(), pack(counts),
                     pack_planes(place[at]), pack_planes(ranks.astype(np.uint32)))]],
                names=["chunk", "doc_id", "held", "lengths", "end", "high", "low", "counts", "tokens", "ranks"])
            made += 1

    return docs.mapInArrow(run, CHUNKS)


def word_cuts(top: np.ndarray, buckets: int) -> list[int]:
    """Where each bucket's part begins in ascending upper halves; the last is the end."""
    bucket = (top.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64)).tolist()


def upper(words: np.ndarray) -> np.ndarray:
    return words >> np.uint64(32)


class Pairs:
    """A chunk's distinct (context, word) pairs, dealt to buckets and sorted within each."""

    def __init__(self, row: dict, buckets: int):
        top = unpack_ascending(row["high"])
        ranks = unpack_planes(row["ranks"], np.uint32).astype(np.int64)
        self.at = ranks[unpack_planes(row["tokens"], np.uint32)]
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.array(row["held"], bool)
        before = np.concatenate(([row["end"]], self.at[:-1]))  # each text ends in an end
        code, self.pair = np.unique(before * len(top) + self.at, return_inverse=True)
        self.u, self.w = code // len(top), code % len(top)
        self.key = (top[self.u] << np.uint64(32)) | top[self.w]
        bucket = (mix(self.key) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(self.key, kind="stable")
        self.order = order[np.argsort(bucket[order], kind="stable")]
        self.cuts = np.searchsorted(bucket[self.order], np.arange(buckets + 1))

    def train_counts(self) -> np.ndarray:
        train = np.repeat(~self.held, self.lengths)
        return np.bincount(self.pair[train], minlength=len(self.key))


def parts_of(rows: pa.Table, kind: int, column: str, dtype) -> list[np.ndarray]:
    """One kind of answer, from all buckets, in bucket order; the other kinds are not copied."""
    some = rows.select(["dest", "kind", column])
    some = some.filter(pc.equal(some.column("kind"), kind))
    order = np.argsort(some.column("dest").to_numpy(), kind="stable")
    return [unpack(some.column(column)[k].as_py(), dtype) for k in order.tolist()]


def joined(rows: pa.Table, kind: int, column: str, dtype) -> np.ndarray:
    found = parts_of(rows, kind, column, dtype)
    return np.concatenate(found) if found else np.zeros(0, dtype)


def give_back() -> None:
    """Let arrays of 1 MB and more go back to the system when they are freed.

    By default the C library keeps them for later once some have been freed, and a
    worker that is used again holds what the largest of its tasks has left in pieces.
    """
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    except (AttributeError, OSError):  # another C library
        pass


def by_chunk(chunks: DataFrame, answers: DataFrame, run, schema: str) -> DataFrame:
    """``run(chunk row, its answers)`` for every chunk."""
    def one(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        return run(left.to_pylist()[0], right)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(one, schema)


# -- seating ----------------------------------------------------------------------

@functools.cache
def stirling(discount: float) -> np.ndarray:
    """log S(c, t): weights of seating c customers at t tables, for c up to ``EXACT``."""
    s = np.full((EXACT + 1, EXACT + 2), -np.inf)
    s[1, 1] = 0.0
    for c in range(2, EXACT + 1):
        t = np.arange(1, c + 1)
        with np.errstate(divide="ignore"):
            stay = s[c - 1, 1:c + 1] + np.log(np.maximum(c - 1 - discount * t, 0))
        s[c, 1:c + 1] = np.logaddexp(s[c - 1, :c], stay)
    return s


def sample_tables(c: np.ndarray, new: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Numbers of tables of ``c`` customers each; ``new`` weighs a new table against a customer.

    t has probability in proportion to S(c, t) new^t, which is drawn as it is
    for up to ``EXACT`` customers. For more, t - 1 is near to Poisson: the
    tables are a Poisson number of mean new phi(r) with independent sizes of
    generating function phi(r x) / phi(r), phi(x) = (1 - (1 - x)^d) / d, under the
    condition that they hold c customers; r is where c is their mean, and the
    condition takes the covariance's share off the variance.
    """
    t = np.minimum(c, 1)
    new = np.maximum(new, 1e-300)
    order = np.argsort(c, kind="stable")
    sizes = np.arange(2, EXACT + 2)
    cuts = np.searchsorted(c[order], sizes).tolist()
    log_s = stirling(discount)
    for size, i, j in zip(sizes.tolist(), cuts, cuts[1:]):
        for at in (order[k:min(k + 1_000_000 // size, j)] for k in range(i, j, 1_000_000 // size)):
            w = log_s[size, 1:size + 1] + np.log(new[at])[:, None] * np.arange(1, size + 1)
            w = np.exp(w - w.max(axis=1, keepdims=True)).cumsum(axis=1)
            t[at] = 1 + (w < (rng.random(len(at)) * w[:, -1])[:, None]).sum(axis=1)
    at = order[cuts[-1]:]
    if len(at):
        many, a = c[at].astype(float), new[at]
        low, high = np.full(len(at), -700.0), np.zeros(len(at))  # log(1 - r)
        for _ in range(60):
            mid = (low + high) / 2
            over = np.log(a) + np.log(-np.expm1(mid)) + (discount - 1) * mid > np.log(many)
            low, high = np.where(over, mid, low), np.where(over, high, mid)
        s = np.exp(high)
        mean = a * -np.expm1(discount * high) / discount
        first = (1 - s) * s ** (discount - 1)  # r phi'(r)
        second = (1 - s) ** 2 * (1 - discount) * s ** (discount - 2)
        spread = np.maximum(mean - a * first * (first / (first + second)), 0)
        drawn = np.where(mean < 30, rng.poisson(np.minimum(mean, 30)),
                         np.rint(mean + np.sqrt(spread) * rng.standard_normal(len(at))))
        t[at] = np.clip(1 + drawn, 1, c[at])
    return t


def add_up(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sums of the values by key, and the place of each key given."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(at, weights=np.concatenate(values), minlength=len(distinct))
    return distinct, np.rint(sums).astype(np.int64), at


# -- the exchanges ----------------------------------------------------------------

def word_counts(chunks: DataFrame, buckets: int) -> tuple[DataFrame, int, int]:
    """Answers of kind 0 with the words' training counts, and what words that share their upper half
    have besides; N and V."""
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, high, low, counts in zip(*(c.to_pylist() for c in b.columns)):
                high, low = unpack_ascending(high), np.frombuffer(low, np.uint32)
                counts, cuts = unpack(counts, np.int32), word_cuts(high, buckets)
                yield from message_table([(k, chunk, 0, pack_ascending(high[i:j]), low[i:j].tobytes(), pack(counts[i:j]))
                                          for k, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]).to_batches()

    def answer(rows: pa.Table) -> pa.Table:
        words = [(unpack_ascending(a) << np.uint64(32)) | np.frombuffer(b, np.uint32)
                 for a, b in zip(rows.column("a").to_pylist(), rows.column("b").to_pylist())]
        distinct, sums, at = add_up(words, [unpack(x, np.int32) for x in rows.column("c").to_pylist()])
        _, top = np.unique(upper(distinct), return_inverse=True)  # a bucket has all words of an upper half
        besides = np.bincount(top, weights=sums)[top].astype(np.int64) - sums if len(sums) else sums
        ends = np.cumsum([0, *map(len, words)])
        dest = rows.column("dest")[0].as_py()
        out = [(dest, chunk, 0, pack(sums[at[i:j]]), pack(besides[at[i:j]]), None) for chunk, i, j in
               zip(rows.column("chunk").to_pylist(), ends, ends[1:])]
        totals = np.array([sums.sum(), (sums > 0).sum()], np.int64)
        return message_table([*out, (dest, None, 9, totals.tobytes(), None, None)])

    answers = stored(chunks.select("chunk", "high", "low", "counts").mapInArrow(ask, MESSAGES).groupBy("dest")
                     .applyInArrow(answer, MESSAGES), "lm-counts")
    n, v = totals_of(answers, np.int64, 2)
    return answers.where("kind = 0"), int(n), int(v)


def totals_of(answers: DataFrame, dtype, size: int) -> np.ndarray:
    """Sum of the buckets' totals (one short row a bucket)."""
    total = np.zeros(size)
    for r in answers.where("kind = 9").select("a").toLocalIterator():
        total = total + np.frombuffer(r["a"], dtype)
    return total


TEXT = ["high", "end", "tokens", "ranks", "lengths", "held"]  # what Pairs needs of a chunk
LEVELS, LEAST_LOG2 = 4, -34  # steps of a factor 2 in which a weight is sent as one byte: 2^-34 to 2^29.75


def pair_seating(chunks: DataFrame, answers: DataFrame, buckets: int, samples: int, seed: int, weigh,
                 again: bool = False) -> DataFrame:
    """Answers of kind 1 (counts and tables of each chunk's pairs) and sums by word.

    The sums are of kind 2 by context and 3 by word, over the pairs of two
    customers or more, and 5 and 6 over those of one, who always sits alone.
    ``weigh(pairs, answers)`` gives log2 of the weight of a new table for each
    pair. ``again`` is for later sweeps, in which only pairs of two customers or
    more have anything to sample; the first sweep's counts are then among the
    answers.
    """
    def ask(row: dict, got: pa.Table) -> pa.Table:
        p = Pairs(row, buckets)
        level = np.clip(np.rint((weigh(p, got) - LEAST_LOG2) * LEVELS), 0, 255).astype(np.uint8)[p.order]
        counts, key, cuts = p.train_counts().astype(np.int32)[p.order], p.key[p.order], p.cuts
        if again:
            keep = joined(got, 1, "a", np.int32) >= 2
            level, counts, key = level[keep], counts[keep], key[keep]
            cuts = np.concatenate(([0], np.cumsum(keep)))[cuts]
        out = []
        for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if i < j:
                u, w = upper(key[i:j]), key[i:j] & np.uint64(0xFFFFFFFF)
                out.append((k, row["chunk"], 1, pack_ascending(u),
                            w.astype(np.uint32).tobytes(),
                            pack(np.concatenate([counts[i:j].view(np.uint8), level[i:j]]))))
        return message_table(out)

    def seat(rows: pa.Table) -> pa.Table:
        give_back()
        dest = rows.column("dest")[0].as_py()
        keys, counts, levels = [], [], []
        for a, b, c in zip(*(rows.column(x).to_pylist() for x in "abc")):
            u = unpack_ascending(a)
            keys.append((u << np.uint64(32)) | np.frombuffer(b, np.uint32))
            n = len(u)
            both = unpack(c, np.uint8)
            counts.append(both[:4 * n].view(np.int32))
            levels.append(both[4 * n:])
        key, c, at = add_up(keys, counts)
        level = np.zeros(len(key))
        level[at] = np.concatenate(levels)  # the same from all chunks
        new = 2.0 ** (level / LEVELS + LEAST_LOG2)
        rng = np.random.default_rng([seed, dest])
        tables = [sample_tables(c, new, DISCOUNT, rng) for _ in range(samples)]
        ends = np.cumsum([0, *map(len, keys)])
        seated = np.stack([c, *tables]).astype(np.int32)
        out = [(dest, chunk, 1, *(pack(x) for x in (seated[0, at[i:j]], seated[1:, at[i:j]])), None)
               for chunk, i, j in zip(rows.column("chunk").to_pylist(), ends, ends[1:])]
        high, low = upper(key), key & np.uint64(0xFFFFFFFF)
        for kind, word, some, drawn in ((2, high, c > 1, tables), (3, low, c > 1, tables),
                                        (5, high, c == 1, [c]), (6, low, c == 1, [c])):
            distinct, where = np.unique(word[some], return_inverse=True)
            sums = np.stack([np.bincount(where, weights=t[some], minlength=len(distinct)) for t in drawn]
                            ).astype(np.int32)
            cuts = word_cuts(distinct, buckets)
            out += [(k, None, kind, pack_ascending(distinct[i:j]), pack(sums[:, i:j]), None)
                    for k, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
        return message_table(out)

    asked = by_chunk(chunks.select("chunk", *TEXT), answers, ask, MESSAGES)
    return stored(asked.groupBy("dest").applyInArrow(seat, MESSAGES), "lm-pairs")


def parent_seating(chunks: DataFrame, seated: DataFrame, buckets: int, samples: int, seed: int, v: int
                   ) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Answers of kind 4 (contexts' tables, words' mass in the parent); its customers and tables by sample."""
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, high in zip(*(c.to_pylist() for c in b.columns)):
                top = unpack_ascending(high)
                cuts = word_cuts(top, buckets)
                yield from message_table([(k, chunk, 4, pack_ascending(top[i:j]), None, None) for k, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]).to_batches()

    def answer(rows: pa.Table) -> pa.Table:
        dest = rows.column("dest")[0].as_py()
        parts: dict[int, list] = {k: [] for k in range(2, 7)}
        for chunk, kind, a, b in zip(*(rows.column(x).to_pylist() for x in ("chunk", "kind", "a", "b"))):
            parts[kind].append((chunk, a, b))
        sums = {}
        for kind in (2, 3):
            rows_of = parts[kind] + parts[kind + 3]  # the ones alone are the same in each sample
            keys = [unpack_ascending(a) for _, a, _ in rows_of]
            values = [np.broadcast_to(x, (samples, x.shape[1])) for x in
                      (unpack(b, np.int32).reshape(samples if k < len(parts[kind]) else 1, -1)
                       for k, (_, _, b) in enumerate(rows_of))]
            per = [add_up(keys, [x[s] for x in values]) for s in range(samples)]
            sums[kind] = (per[0][0], np.stack([x[1] for x in per]))
        rng = np.random.default_rng([seed, 1, dest])
        word, customers = sums[3]
        weight = (ROOT_STRENGTH + ROOT_DISCOUNT * v) / (v + 1)
        tables = np.stack([sample_tables(n, np.full(len(n), weight), ROOT_DISCOUNT, rng) for n in customers])
        mass = customers - ROOT_DISCOUNT * tables
        out = []
        for chunk, a, _ in parts[4]:
            asked = unpack_ascending(a)
            got = []
            for keys, values in ((sums[2][0], sums[2][1]), (word, mass)):
                at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
                hit = keys[at] == asked if len(keys) else np.zeros(len(asked), bool)
                found = values[:, at] if len(keys) else np.zeros((samples, len(asked)))
                got.append(np.where(hit, found, 0).astype(np.float32).T)
            out.append((dest, chunk, 4, pack(got[0]), pack(got[1]), None))
        totals = np.concatenate([customers.sum(axis=1), tables.sum(axis=1)]).astype(np.float64)
        return message_table([*out, (dest, None, 9, totals.tobytes(), None, None)])

    asks = chunks.select("chunk", "high").mapInArrow(ask, MESSAGES)
    both = asks.unionByName(seated)
    answers = stored(both.groupBy("dest").applyInArrow(answer, MESSAGES), "lm-parent")
    totals = totals_of(answers, np.float64, 2 * samples)
    return answers.where("kind = 4"), totals[:samples], totals[samples:]


def release(spark) -> None:
    """Let Spark remove the shuffle files of finished steps now.

    It does so when the driver's JVM collects their handles, which on a large
    heap may be late; nothing depends on it but the disk that is held. The JVM
    hears of the handles that Python has let go with a short delay.
    """
    gc.collect()
    time.sleep(1)
    spark.sparkContext._jvm.System.gc()


def root_probability(mass: np.ndarray, customers: np.ndarray, tables: np.ndarray, v: int) -> np.ndarray:
    return (mass + (ROOT_STRENGTH + ROOT_DISCOUNT * tables) / (v + 1)) / (ROOT_STRENGTH + customers)


SCORED = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def score_documents(docs: DataFrame, held: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                    sweeps: int = 2, samples: int = 2, seed: int = 7) -> DataFrame:
    """Scores of every row, learned from the rows of which the expression ``held`` is not true.

    ``score`` and ``base_score`` are log10 probabilities of the text and its end.
    """
    apart = F.expr(held) if held else fold(id_col, 10) == 0
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), apart.alias("held"), F.col(text_col).alias("text"))
    chunks = stored(tokenised(rows), "lm-chunks")
    size = chunks.select(F.explode("lengths").alias("n")).agg(F.sum("n")).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_TOKENS))
    counts, n, v = word_counts(chunks, buckets)
    release(chunks.sparkSession)

    def from_counts(p: Pairs, got: pa.Table) -> np.ndarray:
        c = np.maximum(joined(got, 0, "a", np.int64) + joined(got, 0, "b", np.int64), 0.5)
        return np.log2(STRENGTH + DISCOUNT * c[p.u] ** 0.85) + np.log2(c[p.w] / max(n, 1))

    weigh, answers, drawn = from_counts, counts, 1
    for sweep in range(sweeps):
        drawn = samples if sweep == sweeps - 1 else 1
        seated = pair_seating(chunks, answers, buckets, drawn, seed + 10 * sweep, weigh, sweep > 0)
        if sweep == 0:
            first = seated
            customers_of = seated.where("kind = 1").withColumn("b", F.lit(None).cast("binary"))
        sums = seated.where("kind in (2, 3)").unionByName(first.where("kind in (5, 6)"))
        release(chunks.sparkSession)
        parent, customers, tables = parent_seating(chunks, sums, buckets, drawn, seed + 10 * sweep, v)

        def from_sweep(p: Pairs, got: pa.Table, customers=customers, tables=tables, drawn=drawn) -> np.ndarray:
            seats = joined(got, 4, "a", np.float32).reshape(-1, drawn)[:, 0].astype(np.float64)
            mass = joined(got, 4, "b", np.float32).reshape(-1, drawn)[:, 0].astype(np.float64)
            p0 = root_probability(mass, customers[0], tables[0], v)
            return np.log2(STRENGTH + DISCOUNT * seats[p.u]) + np.log2(p0[p.w])

        weigh, answers = from_sweep, parent.unionByName(customers_of)
        release(chunks.sparkSession)

    def score(row: dict, got: pa.Table) -> pa.Table:
        p = Pairs(row, buckets)
        c = joined(got, 0, "a", np.int64)
        customers_at = c + joined(got, 0, "b", np.int64)  # of the restaurant that a word is the context of
        seats = joined(got, 4, "a", np.float32).reshape(-1, drawn).astype(np.float64)
        mass = joined(got, 4, "b", np.float32).reshape(-1, drawn).astype(np.float64)
        dealt = joined(got, 1, "a", np.int32)
        sat = np.tile(np.minimum(dealt, 1), (drawn, 1))
        last = parts_of(got, 7, "b", np.int32)
        if last:  # of all pairs after one sweep, else of those of two customers or more
            drawn_tables = np.concatenate([x.reshape(drawn, -1) for x in last], axis=1)
            sat[:, dealt >= 2 if sweeps > 1 else slice(None)] = drawn_tables
            del last, drawn_tables
        seen, at_tables = np.zeros(len(p.key)), np.zeros((drawn, len(p.key)))
        seen[p.order] = dealt
        at_tables[:, p.order] = sat
        chance = np.zeros(len(p.key))
        for s in range(drawn):
            p0 = root_probability(mass[:, s], customers[s], tables[s], v)
            own = seen - DISCOUNT * at_tables[s]
            share = STRENGTH + DISCOUNT * seats[p.u, s]
            chance += (own + share * p0[p.w]) / (STRENGTH + customers_at[p.u])
        logs = np.log10(chance / drawn)
        base = np.log10((c + 0.1) / (n + 0.1 * (v + 1)))
        ends = np.cumsum(p.lengths)[:-1]
        starts = np.concatenate(([0], ends))
        per = lambda x: np.add.reduceat(x, starts)  # noqa: E731  every text has its end
        return pa.table([pa.array(row["doc_id"], pa.int64()), pa.array(row["held"], pa.bool_()),
                         pa.array(p.lengths), pa.array(per((c[p.at] > 0).astype(np.int64))),
                         pa.array(np.full(len(p.lengths), n, np.int64)), pa.array(per(base[p.at])),
                         pa.array(per(logs[p.pair]))],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    last_seats = seated.where("kind = 1").withColumn("kind", F.lit(7))
    final = counts.unionByName(customers_of).unionByName(last_seats).unionByName(parent)
    return by_chunk(chunks.select("chunk", "doc_id", *TEXT), final, score, SCORED)


def op7_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, scored by the model of those whose fold of ten is not 0."""
    return score_documents(table(spark, sf_dir, "documents"))

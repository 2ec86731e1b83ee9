"""Operator 12, ranked lexical search by per-term geometric blocking.

A document is a vector of impacts, one for each of the queries' terms that it
holds; a query weighs terms, and a score is their inner product. Posting lists
are not kept in order of impact or id. Each is clustered by document similarity:
a few of its documents stand for the others, each document goes to the one it is
most like, and so the list falls into geometric blocks. A block's summary is the
coordinatewise maximum of its documents' vectors over all terms, rounded up to a
byte, so a query's product with it is never below the score of a document inside.
A block is skipped only where that bound lies below the score that the query's
last place has already; a list only where the query's terms from there on cannot
reach it. Blocks that stay are scored exactly, so results are those of scoring all.

The index is built in tiles: documents are ordered by their strongest terms, range
partitioned, and each run of ``TILE`` documents makes the pieces of the posting
lists that fall into it, its blocks and its summaries, written as one row. A hot
term is thus a piece in every tile and never one list in one task. Searching is a
map over tiles, with each query's best so far; first over one tile in ``FIRST``,
whose results give every query a score to beat, then over the others. A tile gives
back its ``k`` best for each query, and the ranks are set over those.

The queries are taken in blocks of about ``QUERY_BYTES`` of text. A block's terms,
their weights and its queries are what is broadcast, all bounded by that size; the
documents' numbers (N, L, df) are counted over all of them by Spark.

Defined cases: NULL, empty and term-less texts are in no list and not in N; items
without a term that some document holds give no row; every row of a table counts
for itself, so repeated rows are ranked one behind the other; equal scores are
ordered by id, NULL ids last, then by place in the input; every row of the items
is ranked on its own, also where ids repeat or are NULL; documents of score 0 are
left out; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm.common import prefix_sums, shuffle_partitions, stored, table
from adlens.llm.words import mix, runs

TILE = 1024          # documents of a tile
BLOCK = 64           # documents of a block, about
SCORED_OUTRIGHT = 16  # blocks of so few documents have no summary
FIRST = 16           # one tile in so many is searched first
STEP = 3922          # an impact is below 10^6, so 255 steps of a summary cover it
DIMS = 16            # of the space in which documents are compared
QUERY_BYTES = 256 << 10
RUN_CHARS = 4_000_000

# A term is a maximal run of the bytes 0-9, A-Z, a-z (A-Z lower-cased) and of those of other characters than ASCII.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


# -- queries -----------------------------------------------------------------------------

@dataclass
class Queries:
    """A block of queries: their terms by number, and each query as (terms, repeats)."""

    terms: dict[bytes, int]
    places: list[int]                                # number of the row among the items
    ids: list[int | None]
    wanted: list[tuple[np.ndarray, np.ndarray]]


def numbered_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``place, item_id, text, block`` of the items, in blocks of about ``QUERY_BYTES``."""
    rows = stored(items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"),
                               F.monotonically_increasing_id().alias("place")), "search-items")
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1
    cut = prefix_sums(rows.select("place", size.alias("size")), "size", ["place"], name="search-item-sizes")
    return rows.join(cut.select("place", F.expr(f"before div {QUERY_BYTES}").alias("block")), "place")


def queries_of(block: DataFrame) -> Queries:
    """One block of items, read to the driver: bounded by ``QUERY_BYTES`` and one item."""
    terms: dict[bytes, int] = {}
    out = Queries(terms, [], [], [])
    for r in block.select("place", "item_id", "text").orderBy("place").toLocalIterator():
        ids = [terms.setdefault(t, len(terms)) for t in terms_of(r["text"])]
        if ids:
            out.places.append(r["place"])
            out.ids.append(r["item_id"])
            out.wanted.append(np.unique(np.array(ids, np.int64), return_counts=True))
    return out


# -- document vectors ----------------------------------------------------------------------

def packed(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def vectors(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """``row, doc_id, n, ids, tfs`` of the documents that have a term: all their terms' number, and
    the given terms in them (numbers and occurrences, as binary uint32)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for b in batches:
            at = 0
            for texts in runs(b.column(2).to_pylist(), lambda t: len(t or "") + 50, RUN_CHARS):
                rows, n, ids, tfs = [], [], [], []
                for k, text in enumerate(texts):
                    found = terms_of(text)
                    if found:
                        held = np.array([i for i in map(known, found) if i is not None], np.uint32)
                        held, times = np.unique(held, return_counts=True)
                        rows.append(at + k)
                        n.append(len(found))
                        ids.append(packed(held, np.uint32))
                        tfs.append(packed(times, np.uint32))
                place = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(place), b.column(1).take(place), *[pa.array(v, t) for v, t in zip((n, ids, tfs), kinds[2:])]],
                    names=["row", "doc_id", "n", "ids", "tfs"])
                at += len(texts)

    return docs.mapInArrow(run, "row long, doc_id long, n long, ids binary, tfs binary")


def held_by(found: DataFrame, size: int) -> np.ndarray:
    """df: documents that hold each of the ``size`` terms."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint32), minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["id", "df"])

    summed = found.select("ids").mapInArrow(run, "id int, df long").groupBy("id").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[np.array(summed.column("id").to_pylist(), int)] = summed.column("df").to_pylist()
    return out


@dataclass
class Corpus:
    """What impacts and weights follow from: documents, terms in all, weight of each of the queries' terms."""

    n: int
    length: int
    weights: np.ndarray

    def impacts(self, n: list[int], sizes: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """Impacts of documents of ``n`` terms each, of which ``sizes`` are in ``tfs``."""
        m = np.array([25 + (75 * x * self.n) // self.length for x in n], np.int64)
        tf = tfs.astype(np.int64)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


# -- the index -------------------------------------------------------------------------------

def unit_vectors(ids: np.ndarray, value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Documents in ``DIMS`` dimensions, of length 1: a random projection, the same for a term everywhere."""
    seeds = mix(ids.astype(np.uint64)[:, None] * np.uint64(DIMS) + np.arange(DIMS, dtype=np.uint64))
    random = (seeds >> np.uint64(40)).astype(np.float32) / np.float32(1 << 23) - 1
    out = np.add.reduceat(random * value[:, None].astype(np.float32), first, axis=0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


@dataclass
class Tile:
    """Vectors of a tile's documents, its posting lists in blocks, and the blocks' summaries.

    ``terms`` are the tile's terms; columns are places in it. Vectors go by document
    (``first``, ``cols``, ``impacts``). ``members`` are the documents of all blocks,
    ``ends`` their ends in it, ``lists`` each column's first block. Summaries go by
    column: ``sum_first``, ``sum_blocks``, ``sum_values``.
    """

    rows: np.ndarray
    doc_ids: np.ndarray
    no_id: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    cols: np.ndarray
    impacts: np.ndarray
    members: np.ndarray
    ends: np.ndarray
    lists: np.ndarray
    sum_first: np.ndarray
    sum_blocks: np.ndarray
    sum_values: np.ndarray


KINDS = {"rows": np.int64, "doc_ids": np.int64, "no_id": np.bool_, "terms": np.uint32, "first": np.uint32, "cols": np.uint32,
         "impacts": np.uint32, "members": np.uint32, "ends": np.uint32, "lists": np.uint32, "sum_first": np.uint32,
         "sum_blocks": np.uint32, "sum_values": np.uint8}


def blocks_of(docs: np.ndarray, near: np.ndarray, block: int) -> list[np.ndarray]:
    """A posting list's documents in geometric blocks: each goes to the most similar of a few of them."""
    if len(docs) <= block:
        return [docs]
    k = -(-len(docs) // block)
    heads = docs[np.arange(k) * len(docs) // k]
    to = (near[docs] @ near[heads].T).argmax(axis=1)
    order = np.argsort(to, kind="stable")
    return np.split(docs[order], np.flatnonzero(np.diff(to[order])) + 1)


def build_tile(rows: np.ndarray, doc_ids: np.ndarray, no_id: np.ndarray, sizes: np.ndarray, ids: np.ndarray,
               impacts: np.ndarray, weights: np.ndarray, block: int | None = None) -> Tile:
    """A tile of documents that hold a term each; ``ids`` (in order for each document) and ``impacts`` of all of them."""
    block = block or BLOCK
    first = np.concatenate(([0], np.cumsum(sizes)))
    terms, cols = np.unique(ids, return_inverse=True)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    near = unit_vectors(ids, weights[ids] * impacts / 1e6, first[:-1])
    order = np.argsort(cols, kind="stable")
    held = np.split(doc[order], np.cumsum(np.bincount(cols, minlength=len(terms)))[:-1])
    blocks, lists = [], [0]
    for docs in held:
        blocks.extend(blocks_of(docs, near, block))
        lists.append(len(blocks))
    members = np.concatenate(blocks)
    ends = np.cumsum([len(b) for b in blocks])
    level = np.zeros((len(sizes), len(terms)), np.uint8)
    level[doc, cols] = -(-impacts // STEP)  # rounded up
    found_block, found_col, found_value = [], [], []
    large = [k for k, b in enumerate(blocks) if len(b) > SCORED_OUTRIGHT]
    for part in runs(large, lambda k: len(blocks[k]), 2048):
        starts = np.concatenate(([0], np.cumsum([len(blocks[k]) for k in part])[:-1]))
        most = np.maximum.reduceat(level[np.concatenate([blocks[k] for k in part])], starts, axis=0)
        at, col = np.nonzero(most)
        found_block.append(np.array(part, np.uint32)[at])
        found_col.append(col.astype(np.uint16 if len(terms) < 1 << 16 else np.uint32))
        found_value.append(most[at, col])
    sum_block, sum_col, sum_value = (np.concatenate(x) if x else np.zeros(0, np.uint32)
                                     for x in (found_block, found_col, found_value))
    order = np.argsort(sum_col, kind="stable")
    sum_first = np.concatenate(([0], np.cumsum(np.bincount(sum_col, minlength=len(terms)))))
    return Tile(rows, doc_ids, no_id, terms, first, cols, impacts, members, ends, np.array(lists), sum_first,
                sum_block[order], sum_value[order])


def tile_row(tile: Tile) -> list[bytes]:
    pack = zstandard.ZstdCompressor(level=1).compress
    return [pack(packed(getattr(tile, name), kind)) for name, kind in KINDS.items()]


def row_tile(values: list[bytes]) -> Tile:
    unpack = zstandard.ZstdDecompressor().decompress
    arrays = [np.frombuffer(unpack(v), kind) for v, kind in zip(values, KINDS.values())]
    small = ("no_id", "sum_blocks", "sum_values")  # as they are: the others become places and sums
    return Tile(*[a if name in small else a.astype(np.int64) for name, a in zip(KINDS, arrays)])


def index(found: DataFrame, corpus: Corpus) -> DataFrame:
    """A row for each tile of the documents' ``vectors``: its number and its parts."""
    shared = found.sparkSession.sparkContext.broadcast(corpus)

    def read(b: pa.RecordBatch, at: int = 2):
        ids, tfs = (np.frombuffer(b"".join(b.column(at + k).to_pylist()), np.uint32).astype(np.int64) for k in (1, 2))
        sizes = np.array([len(x) // 4 for x in b.column(at + 1).to_pylist()], np.int64)
        return sizes, ids, shared.value.impacts(b.column(at).to_pylist(), sizes, tfs)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds ``near``: the two terms that weigh most, so that like documents come to stand together."""
        weights = shared.value.weights
        for b in batches:
            sizes, ids, impacts = read(b)
            own = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((ids, -weights[ids] * impacts, own))
            first = np.cumsum(sizes) - sizes
            one, two = ids[order[first]], ids[order[first + (sizes > 1)]]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(one * len(weights) + two)], names=[*b.schema.names, "near"])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, weights = 0, shared.value.weights

        def tile(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            b = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            sizes, ids, impacts = read(b)
            made = build_tile(b.column(0).to_numpy(), b.column(1).fill_null(0).to_numpy(),
                              b.column(1).is_null().to_numpy(zero_copy_only=False), sizes, ids, impacts, weights)
            at = (TaskContext.get().partitionId() << 32) | number
            return pa.RecordBatch.from_arrays([pa.array([at]), *[pa.array([v], pa.binary()) for v in tile_row(made)]],
                                              names=["tile", *KINDS])

        held, n = [], 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                some = b.slice(at, TILE - n)
                held.append(some)
                at, n = at + some.num_rows, n + some.num_rows
                if n == TILE:
                    yield tile(held)
                    held, n, number = [], 0, number + 1
        if held:
            yield tile(held)

    placed = found.where(F.octet_length("ids") > 0).mapInArrow(
        place, "row long, doc_id long, n long, ids binary, tfs binary, near long")
    dealt = placed.repartitionByRange(shuffle_partitions(found.sparkSession), "near", "row").sortWithinPartitions("near", "row")
    return dealt.mapInArrow(build, ", ".join(["tile long", *[f"{c} binary" for c in KINDS]]))


# -- search ------------------------------------------------------------------------------------

@dataclass
class Seen:
    """What a search looked at: blocks and documents there were, and those scored (for tests and figures)."""

    blocks: int = 0
    opened: int = 0
    documents: int = 0
    scored: int = 0


def search_tile(tile: Tile, cols: np.ndarray, weights: np.ndarray, k: int, beat: int, seen: Seen | None = None
                ) -> tuple[np.ndarray, np.ndarray]:
    """The tile's ``k`` best documents (places, scores) that reach ``beat`` for a query of ``weights`` at ``cols``."""
    size = len(tile.rows)
    most = weights * tile.most[cols]
    order = np.argsort(-most, kind="stable")
    rest = np.cumsum(most[order][::-1])[::-1]  # what the terms from here on can give at most
    beat = max(beat, 1)
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(cols) or rest[0] < beat:
        return docs, scores
    at = np.concatenate([np.arange(tile.sum_first[c], tile.sum_first[c + 1]) for c in cols])
    per = np.repeat(weights, tile.sum_first[cols + 1] - tile.sum_first[cols])
    bounds = np.bincount(tile.sum_blocks[at], weights=tile.sum_values[at] * (per * STEP).astype(np.float64),
                         minlength=len(tile.ends))  # whole numbers below 2^53: exact
    wanted = np.zeros(len(tile.terms), np.int64)
    wanted[cols] = weights
    done = np.zeros(size, bool)
    for x, c in enumerate(cols[order].tolist()):
        if rest[x] < beat:
            break
        own = np.arange(tile.lists[c], tile.lists[c + 1])
        opened = own[(bounds[own] >= beat) | (tile.sizes[own] <= SCORED_OUTRIGHT)]
        if seen:
            seen.blocks, seen.opened = seen.blocks + len(own), seen.opened + len(opened)
        if not len(opened):
            continue
        new = np.concatenate([tile.members[tile.ends[b] - tile.sizes[b]:tile.ends[b]] for b in opened.tolist()])
        new = new[~done[new]]
        if not len(new):
            continue
        done[new] = True
        n = tile.first[new + 1] - tile.first[new]
        inside = np.repeat(tile.first[new] - np.cumsum(n) + n, n) + np.arange(n.sum())
        score = np.add.reduceat(tile.impacts[inside] * wanted[tile.cols[inside]], np.cumsum(n) - n)
        keep = score >= beat
        docs, scores = np.concatenate([docs, new[keep]]), np.concatenate([scores, score[keep]])
        if len(scores) >= k:
            beat = max(beat, int(np.partition(scores, -k)[-k]))
            keep = scores >= beat
            docs, scores = docs[keep], scores[keep]
    if seen:
        seen.documents, seen.scored = seen.documents + size, seen.scored + int(done.sum())
    best = np.lexsort((tile.rows[docs], tile.doc_ids[docs], tile.no_id[docs], -scores))[:k]
    return docs[best], scores[best]


def ready(tile: Tile) -> Tile:
    """The tile with what searches derive from it: greatest impact by column, size by block."""
    tile.most = np.zeros(len(tile.terms), np.int64)
    np.maximum.at(tile.most, tile.cols, tile.impacts)
    tile.sizes = np.diff(tile.ends, prepend=0)
    return tile


def searched(tiles: DataFrame, queries: Queries, weights: np.ndarray, k: int, beat: np.ndarray) -> DataFrame:
    """``query, row, doc_id, score``: each tile's ``k`` best for each query, where they reach its ``beat``."""
    shared = tiles.sparkSession.sparkContext.broadcast((queries.wanted, weights, beat))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weights, beat = shared.value
        for b in batches:
            for r in range(b.num_rows):
                tile = ready(row_tile([b.column(c)[r].as_py() for c in range(1, b.num_columns)]))
                found = []
                for q, (ids, times) in enumerate(wanted):
                    at = np.minimum(np.searchsorted(tile.terms, ids), len(tile.terms) - 1)
                    there = tile.terms[at] == ids
                    docs, scores = search_tile(tile, at[there], weights[ids[there]] * times[there], k, int(beat[q]))
                    found.append((np.full(len(docs), q), docs, scores))
                q, docs, scores = (np.concatenate([f[x] for f in found]) for x in range(3))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.astype(np.int32)), pa.array(tile.rows[docs]), pa.array(tile.doc_ids[docs], mask=tile.no_id[docs]),
                     pa.array(scores.astype(np.int64))], names=["query", "row", "doc_id", "score"])

    return tiles.mapInArrow(run, "query int, row long, doc_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query, with their ``rank``."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, doc_col: str = "doc_id", item_col: str = "item_id",
           text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text"))
    cut = numbered_items(items, item_col, text_col)
    blocks = cut.agg(F.max("block")).first()[0]
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(-1 if blocks is None else blocks + 1):
        queries = queries_of(cut.where(F.col("block") == block))
        if not queries.ids:
            continue
        found = stored(vectors(texts, queries.terms), "search-vectors")
        n, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n:
            continue
        corpus = Corpus(n, length, term_weights(n, held_by(found, len(queries.terms))))
        tiles = stored(index(found, corpus), "search-index")
        first = F.pmod(F.xxhash64("tile"), F.lit(FIRST)) == 0
        start = stored(searched(tiles.where(first), queries, corpus.weights, k, np.zeros(len(queries.ids), np.int64)), "search-first")
        beat = np.zeros(len(queries.ids), np.int64)
        for r in best_of(start, k).where(F.col("rank") == k).select("query", "score").collect():  # a number for each query
            beat[r["query"]] = r["score"]
        rest = searched(tiles.where(~first), queries, corpus.weights, k, beat)
        names = spark.createDataFrame(list(enumerate(queries.ids)), "query int, item_id long")
        out = out.unionByName(best_of(start.unionByName(rest), k).join(F.broadcast(names), "query").select(
            "item_id", "rank", "doc_id", "score"))
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` ranked for every ``benchmark`` item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = ("unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[0-9a-z\\x{80}-\\x{10FFFF}]+'))")
OP12_SQL = f"""
WITH doc_terms AS (SELECT row, doc_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM doc_terms GROUP BY ALL),
doc AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS len FROM doc),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wanted AS (SELECT item, item_id, term, count(*) AS times FROM (
    SELECT item, item_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)) GROUP BY ALL),
scored AS (
    SELECT item, item_id, row, doc_id, CAST(sum(
        times * CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // len))))) AS BIGINT) AS score
    FROM wanted JOIN tf USING (term) JOIN doc USING (row) JOIN df USING (term), corpus GROUP BY ALL),
ranks AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST, row) AS rank
          FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranks WHERE rank <= 10
"""

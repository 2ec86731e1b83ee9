"""Operator 10, near-dedup by SuperMinHash, banding, verification and union-find.

SuperMinHash gives each shingle one random permutation of the signature's
places; in step j a shingle offers ``j + r`` (r in [0, 1)) to the j-th place of
its permutation, and a place keeps the least offer. Later steps cannot beat
earlier ones, so a document stops as soon as all places hold an offer. The
steps run on arrays over all shingles of a run of documents.

Rows with equal shingle sets form a class first (128-bit digest of the sorted
set), and only classes go on, so a text in thousands of copies is one node.
Classes that share a band's hash are candidates. In each bucket all members
are verified against one pivot, which settles most groups of copies in a few
comparisons a member, and union-find gives the components so far. Members of
one bucket that are still in different components are compared in blocks, each
within one task that counts overlaps and returns links only; a large bucket is
dealt into tiles. No pairs are emitted and no link is given up. A link is
confirmed on the full sets.

``BANDS`` x ``ROWS`` finds a pair at similarity s with 1 - (1 - s^4)^24: all
but 4 in a million at 0.8, and all more similar ones nearly surely.

Defined cases: NULL, empty and blank texts have no shingles and link with
nothing; a text with fewer words than a shingle is one shingle; a component's
id is its smallest non-NULL id; repeated rows belong to one class, and exactly
one row of each component has ``stays``; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import PLACE, place_or_null, stored, table, text_hash
from adlens.llm.components import components
from adlens.llm.words import ODD, WordHash, mix, runs, words_of

BANDS, ROWS = 24, 4
BLOCK, BLOCK_ELEMENTS = 1000, 1_000_000  # most members and shingles of a tile
RUN_WORDS = 200_000  # words handled at once; a longer text is a run of its own
UNSET = np.uint64(2 ** 64 - 1)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's word hashes."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    h = words[:n - width + 1]
    for i in range(1, width):
        h = h * ODD + words[i:n - width + 1 + i]
    h = np.sort(mix(h + np.uint64(width)))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, a row of ``m`` for each non-empty set."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets)
    sig = np.full(len(sets) * m, UNSET)
    perm = None  # places not used yet, for the shingles still in play
    low = np.uint64(0xFFFFFFFF)
    for j in range(m):
        z = mix(x + np.uint64((j + 1) * int(ODD) % 2 ** 64))
        k = j + (((z & low) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        offer = (np.uint64(j) << np.uint64(32)) | (z >> np.uint64(32))
        if j == 0:
            place = k
        else:
            row = np.arange(len(x))
            place = perm[row, k].astype(np.int64)
            perm[row, k] = perm[row, j]
        at = owner * m + place
        free = sig[at] >= (np.uint64(j) << np.uint64(32))
        np.minimum.at(sig, at[free], offer[free])
        if j == 0 or j < 8 or j % 8 == 0:
            open_ = (sig.reshape(-1, m) == UNSET).any(axis=1)[owner]
            if not open_.any():
                break
            x, owner = x[open_], owner[open_]
            if j == 0:
                k = k[open_]
                perm = np.tile(np.arange(m, dtype=np.uint16), (len(x), 1))
                perm[np.arange(len(x)), k] = 0
            else:
                perm = perm[open_]
    return sig.reshape(-1, m)


def digest(s: np.ndarray) -> bytes:
    return blake2b(s.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """``_row, doc_id, text_hash, _place, n, key, bands`` of ``_row, doc_id, text_hash, _place, text``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        tags = np.arange(BANDS, dtype=np.uint64) * ODD
        for b in batches:
            at = 0
            for texts in runs(b.column(4).to_pylist(), lambda t: len(t or "") // 6 + 1, RUN_WORDS):
                sets = [shingle_set(hashes.of(words_of(t)), k) for t in texts]
                full = [s for s in sets if len(s)]
                bands = np.zeros((0, BANDS), np.int64)
                if full:
                    sig = super_minhash(full, BANDS * ROWS).reshape(-1, BANDS, ROWS)
                    h = sig[:, :, 0]
                    for i in range(1, ROWS):
                        h = h * ODD + sig[:, :, i]
                    bands = mix(h + tags).view(np.int64)
                ends = np.cumsum([0, *[BANDS if len(s) else 0 for s in sets]])
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i).slice(at, len(texts)) for i in range(4)],
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands.ravel()))],
                    names=["_row", "doc_id", "text_hash", "_place", "n", "key", "bands"])
                at += len(texts)

    return docs.mapInArrow(run, f"_row bigint, doc_id bigint, text_hash bigint, _place {PLACE}, n bigint, key binary, bands array<bigint>")


def full_sets(texts: DataFrame, k: int) -> DataFrame:
    """``key, elements`` of the one column of texts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for b in batches:
            for part in runs(b.column(0).to_pylist(), lambda t: len(t or "") // 6 + 1, RUN_WORDS):
                sets = [shingle_set(hashes.of(words_of(t)), k) for t in part]
                ends = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(s) for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                              pa.array(np.concatenate(sets).view(np.int64)))],
                    names=["key", "elements"])

    return texts.mapInArrow(run, "key binary, elements array<bigint>")


def close_sizes(x: str, y: str, percent: int):
    """Whether sets of these sizes can reach the threshold."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, same, either``: sizes of intersection and union of the pairs' sets."""
    left = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    right = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    both = pairs.join(left, "b").join(right, "a")
    same = F.size(F.array_intersect("ea", "eb")).cast("long")
    return both.select("a", "b", same.alias("same"), (F.size("ea") + F.size("eb")).alias("all")).select(
        "a", "b", "same", (F.col("all") - F.col("same")).alias("either"))


def linked(checked: DataFrame, percent: int) -> DataFrame:
    return checked.where(F.col("same") * 100 >= F.col("either") * percent).select("a", "b")


def rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the root of their component as ``root``."""
    roots = components(links)
    return members.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of the left sets with the right ones, from the sets each element is in."""
    both = np.zeros((len(left), len(right)), np.int32)
    owner = np.concatenate([np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)])
    side = np.repeat([False, True], [sum(map(len, left)), sum(map(len, right))])
    elements = np.concatenate([*left, *right])
    order = np.lexsort((side, elements))
    elements, owner, side = elements[order], owner[order], side[order]
    cuts = np.flatnonzero(np.concatenate(([True], elements[1:] != elements[:-1], [True])))
    ahead = np.concatenate(([0], np.cumsum(~side)))
    split = cuts[:-1] + ahead[cuts[1:]] - ahead[cuts[:-1]]  # where an element's right sets begin
    some = (split > cuts[:-1]) & (split < cuts[1:])
    for i, k, j in zip(cuts[:-1][some].tolist(), split[some].tolist(), cuts[1:][some].tolist()):
        both[owner[i:k, None], owner[k:j]] += 1
    return both


def spanning_links(nodes: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], other: np.ndarray, percent: int
                   ) -> list[tuple[int, int]]:
    """Links between different components of a block, as many as it takes to connect them.

    Where some members are of the block's ``other`` tile, pairs of one of each are compared, else all pairs.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    rows, columns = (np.flatnonzero(~other), np.flatnonzero(other)) if other.any() and not other.all() else (
        np.arange(len(sets)),) * 2
    both = overlaps([sets[k] for k in rows], [sets[k] for k in columns])
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    out = []
    for k, a in enumerate(rows.tolist()):
        same = both[k].astype(np.int64)
        near = columns[(same * 100 >= (sizes[a] + sizes[columns] - same) * percent) & (roots[columns] != roots[a])]
        near_roots, first = np.unique(roots[near], return_index=True)  # one link to each component is enough
        for root, b in zip(near_roots.tolist(), near[first].tolist()):
            x, y = find(int(roots[a])), find(root)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((int(nodes[a]), int(nodes[b])))
    return out


def block_links(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between members of one bucket that are in different components (stored).

    A bucket of more than ``BLOCK`` members or ``BLOCK_ELEMENTS`` shingles is
    dealt into tiles by a hash, and each tile, and each pair of tiles, is a block; a
    block is compared in one task, which returns links only. Pairs inside a tile are
    compared in its own block and not again.
    """
    sizes = rest.groupBy("bucket").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK),
                                                  F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("long").alias("tiles"))
    tile = F.pmod(F.xxhash64("node"), F.col("tiles"))
    dealt = rest.select("bucket", "node", "root").join(sizes, "bucket").withColumn("own", tile).withColumn(
        "other", F.explode(F.expr("sequence(0L, tiles - 1)"))).select(
        "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") > F.col("other")).alias("second"), "node", "root")

    def compare(block: pa.Table) -> pa.Table:
        nodes, roots, second = (block.column(c).to_numpy() for c in ("node", "root", "second"))
        elements = [x.values.to_numpy() for x in block.column("elements")]
        order = np.argsort(nodes, kind="stable")
        found = spanning_links(nodes[order], roots[order], [elements[k] for k in order],
                               second[order].astype(bool), percent)
        return pa.table([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                        names=["a", "b"])

    blocks = dealt.join(sets, "node").groupBy("bucket", "x", "y")
    return stored(blocks.applyInArrow(compare, "a bigint, b bigint"), "near-links")


def near_dedup(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``_row, _place, doc_id, n_shingles, component_id, kept, stays``, a row per input row.

    ``_place`` leads back to the input (``common.at_rows``);
    ``stays`` is true for one row of each component.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"),
                       text_hash(text).alias("text_hash"), place_or_null(docs).alias("_place"), text.alias("text"))
    sig = stored(signatures(rows, shingle_words), "near-signatures")
    classes = sig.where("n > 0").groupBy("key").agg(F.min("_row").alias("node"), F.min("doc_id").alias("id"))
    nodes = stored(sig.withColumnRenamed("_row", "node").join(classes.drop("key"), "node").select(
        "key", "node", "id", "n", "bands", "doc_id", "text_hash"), "near-classes")

    # buckets of two classes or more, and their members
    band = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    pivots = (band.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("c"))
              .where("c > 1").select("bucket", "pivot"))
    members = stored(band.join(pivots, "bucket"), "near-members")

    # the full sets of the classes in them, read again from the texts
    wanted = members.select("node").distinct().join(nodes.select("node", "key", "doc_id", "text_hash"), "node")
    wanted = stored(wanted, "near-wanted")
    whole = rows.select("doc_id", "text_hash", "text")
    found = whole.join(wanted.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")),
                       F.expr("text_hash = h and doc_id <=> d"), "left_semi").select("text")
    sets = full_sets(found, shingle_words).groupBy("key").agg(F.any_value("elements").alias("elements"))
    sets = stored(wanted.select("node", "key").join(sets, "key").select("node", "elements"), "near-sets")
    sizes = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("pivot_n"))

    def against_pivots(at: DataFrame) -> DataFrame:
        pairs = (at.where("node <> pivot").select("node", "n", "pivot").distinct().join(sizes, "pivot")
                 .where(close_sizes("n", "pivot_n", percent))
                 .select(F.col("pivot").alias("a"), F.col("node").alias("b")))
        return stored(verified(pairs, sets), "near-verified")

    first = against_pivots(members)
    links = linked(first, percent)
    members = stored(rooted(members, links), "near-members")

    def unsettled(at: DataFrame) -> DataFrame:
        """Members but the pivot, of buckets in which these belong to more than one component."""
        rest = at.where("node <> pivot")
        mixed = rest.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where(
            "r0 <> r1").select("bucket")
        return rest.join(mixed, "bucket")

    rest = stored(unsettled(members), "near-unsettled")
    if not rest.isEmpty():
        links = links.unionByName(block_links(rest, sets, percent))
    roots = components(links)

    # back from nodes to rows
    of = nodes.select("key", "node", "id").join(roots, "node", "left").select(
        "key", "id", F.coalesce("root", "node").alias("root"))
    ids = of.groupBy("root").agg(F.min("id").alias("component_id"))
    of = stored(of.join(ids, "root").select("key", "root", "component_id"), "near-classes")
    out = sig.drop("bands").join(of, "key", "left").select(
        "_row", "_place", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "_row").alias("root"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    out = stored(out, "near-rows")
    best = out.groupBy("root").agg(F.min_by("_row", F.coalesce("doc_id", F.lit(2 ** 63 - 1))).alias("_stays"))
    return out.join(best, "root").select(
        "_row", "_place", "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        (F.col("_row") == F.col("_stays")).alias("stays"))


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` by near copies: 4-word shingles, similarity 0.8 or more."""
    return near_dedup(table(spark, sf_dir, "documents"), shingle_words=4).drop("_row", "_place", "stays")

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import lexical_search as search
from adlens.llm.lexical_search import OP12_SQL, Corpus, Seen, build_tile, op12_lexical_search, ranked, ready, row_tile, search_tile, terms_of, tile_row

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string"


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    found = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, length = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        wanted = Counter(TERM.findall((text or "").translate(LOWER)))
        rows = []
        for row, (doc, c, n) in enumerate(found):
            m = 25 + (75 * n * n_docs) // length
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, times in wanted.items() if t in c)
            if score > 0:
                rows.append((-score, doc is None, doc or 0, row, doc))
        out += [(item, r, x[4], -x[0]) for r, x in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert got(op12_lexical_search(spark, sf)) == sorted(con.execute(OP12_SQL).fetchall(), key=str)


def test_terms_are_those_of_the_pattern(edge_rows):
    for text in [r[1] for r in edge_rows] + ["A_b-C9{x}~\x7f\x80y", "".join(map(chr, range(1, 400)))]:
        assert [t.decode() for t in terms_of(text)] == TERM.findall((text or "").translate(LOWER))


def test_edge_rows(spark, edge, edge_rows):
    items = [(1, "the CAT sat the cat"), (1, "the CAT sat the cat"), (2, None), (3, ""), (None, "one w1x1 été"), (4, "zzz nowhere"),
             (5, "日本語 été é")]
    frame = spark.createDataFrame(items, ITEMS).withColumns({c: F.lit(0) for c in ("rank", "score", "place", "query", "block")})
    assert got(ranked(edge, frame)) == brute([r[:2] for r in edge_rows], items)


def test_hot_group_and_small_tiles(spark, small, monkeypatch):
    """A third of all rows are copies of one text; lists are cut into many tiles and blocks."""
    rows = [(r["doc_id"], r["text"]) for r in small.select("doc_id", "text").orderBy("doc_id").limit(240).collect()]
    rows += [(5000 + i, rows[7][1]) for i in range(120)]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").limit(12).collect()]
    items.append((99, rows[7][1]))
    monkeypatch.setattr(search, "TILE", 50)
    monkeypatch.setattr(search, "BLOCK", 6)
    monkeypatch.setattr(search, "FIRST", 3)
    monkeypatch.setattr(search, "SCORED_OUTRIGHT", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, items)
    assert got(ranked(docs, spark.createDataFrame(items, ITEMS))) == want
    monkeypatch.setattr(search, "QUERY_BYTES", 400)  # several blocks of queries
    assert got(ranked(docs, spark.createDataFrame(items, ITEMS))) == want


def tile_of(rng, n_docs, n_terms, groups):
    """Documents that fall into groups, each with terms of its own besides the common ones."""
    ids, impacts, sizes = [], [], []
    own = n_terms // groups
    for d in range(n_docs):
        g = d % groups
        terms = np.unique(np.concatenate([rng.integers(0, 10, 4), own * g + rng.integers(0, own, 8)]))
        ids.append(terms)
        impacts.append(rng.integers(1, 10 ** 6, len(terms)))
        sizes.append(len(terms))
    weights = rng.integers(1, 12_000, n_terms)
    tile = build_tile(np.arange(n_docs), np.arange(n_docs)[::-1].copy(), np.zeros(n_docs, bool), np.array(sizes),
                      np.concatenate(ids), np.concatenate(impacts), weights, block=16)
    return ready(row_tile(tile_row(tile))), weights


def test_summaries_bound_and_skip(monkeypatch):
    monkeypatch.setattr(search, "SCORED_OUTRIGHT", 3)
    rng = np.random.default_rng(4)
    tile, weights = tile_of(rng, 1500, 400, 20)
    seen = Seen()
    for _ in range(40):
        g = int(rng.integers(20))
        cols = np.unique(np.concatenate([rng.integers(0, 10, 2), 20 * g + rng.integers(0, 20, 5)]))
        cols = cols[np.isin(tile.terms[np.minimum(cols, len(tile.terms) - 1)], cols)]
        at = np.searchsorted(tile.terms, cols)
        times = weights[cols] * rng.integers(1, 3, len(cols))
        wanted = np.zeros(len(tile.terms), np.int64)
        wanted[at] = times
        scores = np.add.reduceat(tile.impacts * wanted[tile.cols], tile.first[:-1])
        best = np.lexsort((tile.rows, tile.doc_ids, -scores))[:10]
        best = best[scores[best] > 0]
        docs, found = search_tile(tile, at, times, 10, 0, seen)
        assert docs.tolist() == best.tolist() and found.tolist() == scores[best].tolist()
        docs, found = search_tile(tile, at, times, 10, int(scores[best[-1]]))
        assert docs.tolist() == best.tolist()
    assert seen.opened < 0.8 * seen.blocks and seen.scored < 0.3 * seen.documents


def test_every_summary_is_the_rounded_maximum(monkeypatch):
    monkeypatch.setattr(search, "SCORED_OUTRIGHT", 3)
    tile, _ = tile_of(np.random.default_rng(9), 300, 100, 5)
    level = np.zeros((300, len(tile.terms)), np.int64)
    level[np.repeat(np.arange(300), np.diff(tile.first)), tile.cols] = -(-tile.impacts // search.STEP)
    assert level.max() <= 255
    col = np.repeat(np.arange(len(tile.terms)), np.diff(tile.sum_first))
    for b, (size, end) in enumerate(zip(tile.sizes.tolist(), tile.ends.tolist())):
        most = level[tile.members[end - size:end]].max(axis=0)
        own = tile.sum_blocks == b
        if size > search.SCORED_OUTRIGHT:
            assert (np.flatnonzero(most) == col[own]).all() and (most[most > 0] == tile.sum_values[own]).all()
        else:
            assert not own.any()
    held = [set(tile.members[tile.ends[lo] - tile.sizes[lo]:tile.ends[hi - 1]].tolist())
            for lo, hi in zip(tile.lists[:-1], tile.lists[1:])]
    assert held == [set(np.flatnonzero(level[:, c]).tolist()) for c in range(len(tile.terms))]  # every row is indexed


def test_no_overflow_at_scale():
    corpus = Corpus(5 * 10 ** 10, 2 * 10 ** 13, np.zeros(1, np.int64))
    n = [10 ** 7, 400]
    want = [(10 ** 9 * tf) // (1000 * tf + 8 * (25 + 75 * x * corpus.n // corpus.length)) for x, tf in zip(n, (9, 3))]
    assert corpus.impacts(n, np.array([1, 1]), np.array([9, 3])).tolist() == want


def test_empty_tables(spark, empty, small):
    items = spark.createDataFrame([(1, "the")], ITEMS)
    assert got(ranked(empty, items)) == got(ranked(small, items.limit(0))) == []

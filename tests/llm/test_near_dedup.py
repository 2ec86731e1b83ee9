import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import near_dedup as nd
from adlens.llm.components import components
from adlens.llm.words import WordHash, mix, words_of


def shingles(text, k):
    w = words_of(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k):
    """All pairs, by definition; component ids as the contract has them."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(rows)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def got(df):
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()], key=str)


def edited(rng, words, share):
    return " ".join("x%d" % rng.randrange(10 ** 6) if rng.random() < share else w for w in words)


def test_groups_of_near_copies(spark):
    """Copies at all distances of one text, linked in chains, and buckets with many components."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = [(k, edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.04, 0.08]))) for k in range(260)]
    rows += [(1000 + k, edited(rng, [f"v{rng.randrange(50)}" for _ in range(60)], 0.0)) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(nd.near_dedup(df, shingle_words=4)) == brute(rows, 4)
    before, nd.BLOCK = nd.BLOCK, 20  # many tiles
    try:
        assert got(nd.near_dedup(df, shingle_words=4)) == brute(rows, 4)
    finally:
        nd.BLOCK = before


def test_small_table(small):
    rows = [tuple(r) for r in small.where("doc_id < 400").select("doc_id", "text").collect()]
    assert got(nd.near_dedup(small.where("doc_id < 400"), shingle_words=4)) == brute(rows, 4)


def test_edge_rows(edge, edge_rows):
    out = nd.near_dedup(edge, shingle_words=4)
    assert got(out) == brute([(i, t) for i, t, *_ in edge_rows], 4)
    stays = [r for r in out.collect() if r["stays"]]
    assert len(stays) == len(edge_rows) - 3  # a repeated row, its copy in capitals, "one" twice
    assert not any(r["kept"] for r in out.where("doc_id is null").collect())


def test_empty(empty):
    assert nd.near_dedup(empty).collect() == []


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    seen = []
    for k in range(60):
        x = mix(rng.integers(0, 2 ** 63, 400).astype(np.uint64))
        a, b = x[:300], x[60:360]
        sig = nd.super_minhash([a, b, a[::-1], x[:2]], 96)
        assert (sig != nd.UNSET).all() and (sig[0] == sig[2]).all()
        # the two offers of a small set are permutations: each step is used at each place at most once
        assert len(set((sig[3] >> np.uint64(32)).tolist())) > 30
        seen.append((sig[0] == sig[1]).mean())
    assert np.mean(seen) == pytest.approx(240 / 360, abs=0.02)
    assert np.std(seen) < np.sqrt(2 / 3 / 3 / 96)  # less than plain minhash


def test_shingle_set():
    h = WordHash()
    for text, k in (("a b c d e a b c d", 4), ("a b", 4), ("", 4), ("a a a a a a", 2)):
        assert len(nd.shingle_set(h.of(words_of(text)), k)) == len(shingles(text, k))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(500, 560)]
    edges += [(1000, k) for k in range(1001, 1200)]  # a hot node
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in rows} == {x: find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hot_copies(spark):
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a b c d e f").otherwise(
        F.concat_ws(" ", "id", F.col("id") * 7, F.col("id") * 13, F.col("id") * 17, F.col("id") * 19)).alias("text"))
    out = nd.near_dedup(df)
    assert out.where("stays").count() == 601 and out.where("component_id = 0").count() == 300

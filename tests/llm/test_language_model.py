import math
import zlib
from collections import Counter

import numpy as np
import pytest

from adlens.llm import language_model as lm
from adlens.llm.words import words_of


def tokens(text):
    return [*words_of(text), b""]


def base(rows, held):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    return counts, n, {i: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)) for i, t in rows}


def test_base_and_held_out_gain(spark, small, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_WORDS", 30_000)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 60_000)  # several chunks and buckets
    rows = lm.score_documents(small).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    counts, n, want = base(list(texts.items()), held)
    for r in rows:
        found = tokens(texts[r["doc_id"]])
        assert r["held_out"] == held(r["doc_id"]) and r["train_tokens"] == n
        assert r["n_tokens"] == len(found) and r["n_known"] == sum(counts[w] > 0 for w in found)
        assert r["base_score"] == pytest.approx(want[r["doc_id"]], rel=1e-9)
    apart = [r for r in rows if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in apart) / sum(r["n_tokens"] for r in apart)
    assert gain > 0.5  # log10 a token
    assert sum(r["score"] > r["base_score"] for r in apart) > 0.9 * len(apart)


def test_probabilities_sum_to_one(spark):
    """Over all words and the unknown one, from the scores of texts that differ in one token."""
    rows = [(k, "a b a b b c") for k in range(1, 30)] + [(k, "c a") for k in range(30, 40)]
    learn = spark.createDataFrame([(*r, False) for r in rows], "doc_id long, text string, held boolean")
    ask = ["", "a", "a a", "a b", "a c", "a zz", "b", "c", "zz", "a a a"]
    asks = spark.createDataFrame([(1000 + k, t, True) for k, t in enumerate(ask)], learn.schema)
    out = {r["doc_id"]: 10 ** r["score"] for r in lm.score_documents(
        learn.unionByName(asks), held="held", sweeps=2, samples=1).where("held_out").collect()}
    p = {t: out[1000 + k] for k, t in enumerate(ask)}
    # after "a": P(a|a), P(end|a) from "a a a" / "a a" and so on; contexts of held-out words only share the root
    aa = p["a a a"] / p["a a"]
    assert p["a a"] / p["a"] == pytest.approx(aa, rel=1e-9)
    assert 0 < aa < 1 and p["a b"] > p["a zz"]


def test_parent_sums_to_one():
    customers, tables, v = 1000.0, 300.0, 50
    n = np.arange(50) * 40.0
    t = np.ceil(n / 4)
    n, t = n * customers / n.sum(), t * tables / t.sum()
    p = lm.root_probability(n - lm.ROOT_DISCOUNT * t, customers, tables, v)
    unknown = lm.root_probability(np.zeros(1), customers, tables, v)
    assert p.sum() + unknown[0] == pytest.approx(1.0)


@pytest.mark.parametrize("customers", [2, 5, 20])
@pytest.mark.parametrize("new", [0.01, 1.0, 20.0])
def test_block_sampling_agrees_with_single_customers(customers, new):
    """The number of tables, against Gibbs moves of one customer at a time."""
    rng = np.random.default_rng(1)
    drawn = lm.sample_tables(np.full(4000, customers), np.full(4000, new), 0.8, rng)
    sizes, seen = [customers], []
    for step in range(40_000):
        k = rng.choice(len(sizes), p=np.array(sizes) / sum(sizes))
        sizes[k] -= 1
        if not sizes[k]:
            sizes.pop(k)
        w = np.array([s - 0.8 for s in sizes] + [new])
        k = rng.choice(len(w), p=w / w.sum())
        if k == len(sizes):
            sizes.append(1)
        else:
            sizes[k] += 1
        seen.append(len(sizes))
    assert drawn.mean() == pytest.approx(np.mean(seen[500:]), abs=0.25)


@pytest.mark.parametrize("new", [0.05, 1.0, 30.0, 600.0, 5000.0])
def test_large_dishes_follow_the_exact_law(new):
    """Just above the size up to which the law is drawn as it is."""
    rng = np.random.default_rng(2)
    n = lm.EXACT
    exact = lm.sample_tables(np.full(3000, n), np.full(3000, new), 0.8, rng)
    limit = lm.sample_tables(np.full(3000, n + 1), np.full(3000, new), 0.8, rng)
    assert limit.mean() == pytest.approx(exact.mean(), rel=0.03, abs=0.1)
    assert limit.std() == pytest.approx(exact.std(), rel=0.15, abs=0.1)
    few = lm.sample_tables(np.array([0, 1, 10 ** 6, 2]), np.full(4, new), 0.8, rng)
    assert (few <= [0, 1, 10 ** 6, 2]).all() and few[1] == 1 and few[0] == 0 and few[2] >= 1


def test_edge_rows(edge, edge_rows):
    rows = lm.score_documents(edge).collect()
    assert len(rows) == len(edge_rows)
    assert sorted(r["n_tokens"] for r in rows) == sorted(len(tokens(t)) for _, t, *_ in edge_rows)
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in rows)
    again = lm.score_documents(edge).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_no_training_rows(spark, empty):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = lm.score_documents(df, held="true").collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in rows)
    assert sorted(r["score"] for r in rows) == pytest.approx([0.0, 0.0], abs=1e-9)  # one unknown word, V = 0
    assert lm.score_documents(empty).collect() == []


def test_words_that_agree_in_half_their_hash(spark):
    """Two words of one upper half, one frequent and one met once: no score passes 1."""
    import xxhash
    one, two = "w57212", "w67677"
    assert len({xxhash.xxh3_64_intdigest(w.encode()) >> 32 for w in (one, two)}) == 1
    rows = [(k, f"{one} a {one} b {one} a") for k in range(200)] + [(900, f"{two} a"), (901, "c d")]
    asks = [f"{one} a", f"{two} a", f"{two} b", f"{two} {one}", f"a {two}", f"{two} {two} {two} a a b", "c d"]
    learn = [(*r, False) for r in rows] + [(1000 + k, t, True) for k, t in enumerate(asks)]
    df = spark.createDataFrame(learn, "doc_id long, text string, held boolean")
    out = {r["doc_id"]: r for r in lm.score_documents(df, held="held").collect()}
    assert all(r["score"] <= 0 for r in out.values())
    apart = Counter(w for _, t in rows for w in tokens(t))
    n, v = sum(apart.values()), len(apart)
    for k, t in enumerate(asks):  # the counts behind the base stay apart
        want = sum(math.log10((apart[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
        assert out[1000 + k]["base_score"] == pytest.approx(want, rel=1e-9)


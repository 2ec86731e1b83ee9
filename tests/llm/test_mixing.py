import re

import pytest
from pyspark.sql import functions as F

from adlens.llm.mixing import mix_slots, mix_sources, mixed_documents, permute, shard_counts, source_targets

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(sizes):
    """Share by weight; stop at three times; share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, free = {}, set(order)
    left = float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 3 * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / total for s in free}
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def check(rows, source, exact=0.02):
    sizes, taken = {}, {}
    for s, t in source:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    assert sorted(r["size"] for r in rows) == sorted(len(WORD.findall(t or "")) for _, t in source)
    for r in rows:
        assert r["taken"] <= 3 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(exact * want[s], min(64, sizes[s] / 32 + 1))


def test_against_brute_force(small):
    mixed = mix_sources(small).join(small.select("doc_id", "source"), "doc_id")
    rows = mixed.collect()
    check(rows, [tuple(r) for r in small.select("source", "text").collect()])
    assert sorted(map(tuple, mix_sources(small.repartition(5)).collect())) == sorted(
        map(tuple, mix_sources(small).collect()))


def test_edge_rows(edge, edge_rows):
    rows = mix_sources(edge).collect()
    assert len(rows) == len(edge_rows)
    sizes = {}
    for _, t, _, s, _ in edge_rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = sorted(brute_targets(sizes)[r[3]] for r in edge_rows)
    assert sorted(r["target"] for r in rows) == pytest.approx(want)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)


def test_targets_with_caps(spark):
    sizes = {"a": 1000, "b": 5, "c": 10, None: 1, "d": 0, "é": 70}
    df = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()], "_null boolean, _src string, size long")
    rows = {None if r["_null"] else r["_src"]: r["target"] for r in source_targets(df).collect()}
    assert rows == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 1000])
def test_permute(spark, n):
    got = [r[0] for r in spark.range(n).select(permute(F.col("id"), F.lit(n), F.lit("k"))).collect()]
    assert sorted(got) == list(range(n))
    assert n < 64 or got != list(range(n))


def test_documents_of_the_mix(small):
    """The words of the mix's documents are those that the plan takes, in runs of the original."""
    plan = {r["doc_id"]: r["taken"] for r in mix_sources(small).collect()}
    texts = {r["doc_id"]: WORD.findall(r["text"]) for r in small.collect()}
    mixed = mixed_documents(small)
    assert mixed.columns == small.columns
    words = {}
    for r in mixed.collect():
        found = WORD.findall(r["text"])
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(found)
        at = iter(texts[r["doc_id"]])
        assert all(w in at for w in found)
    assert words == {d: n for d, n in plan.items() if n}


def test_empty(empty):
    assert mix_sources(empty).collect() == []
    assert mixed_documents(empty).collect() == []


def test_no_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mix_sources(df).collect()] == [(0.0, 0), (0.0, 0)]


def targets_of(spark, sizes):
    return source_targets(spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()],
                                                "_null boolean, _src string, size long"))


def test_every_shard_is_drawn(spark):
    """Counts of each shard: full shards, totals that the targets ask for, and spread like a draw's."""
    sizes = {"a": 640_000, "b": 320_000, "c": 64_000}
    targets = targets_of(spark, sizes)
    drawn = shard_counts(targets, 64, 256, 7).collect()
    per_shard, per_source = {}, {}
    for r in drawn:
        per_shard[r["shard"]] = per_shard.get(r["shard"], 0) + r["count"]
        per_source[r["_src"]] = per_source.get(r["_src"], 0) + r["count"]
    wanted = {r["_src"]: r["target"] / 64 for r in targets.collect()}
    assert all(abs(per_source[s] - wanted[s]) <= 1 for s in sizes)
    assert sorted(per_shard) == list(range(len(per_shard)))
    assert all(n == 256 for s, n in per_shard.items() if s + 1 < len(per_shard))
    total = sum(wanted.values())
    p = wanted["b"] / total
    counts = [r["count"] for r in drawn if r["_src"] == "b" and r["shard"] + 1 < len(per_shard)]
    mean, spread = sum(counts) / len(counts), (sum((c - 256 * p) ** 2 for c in counts) / len(counts)) ** 0.5
    assert abs(mean - 256 * p) < 5 and 0.6 < spread / (256 * p * (1 - p)) ** 0.5 < 1.5
    other = {(r["shard"], r["_src"]): r["count"] for r in shard_counts(targets, 64, 256, 8).collect()}
    assert other != {(r["shard"], r["_src"]): r["count"] for r in drawn}


def test_slots_follow_the_draw(spark):
    targets = targets_of(spark, {"a": 6_400, "b": 700, None: 90})
    drawn = {(r["shard"], r["_null"], r["_src"]): r["count"] for r in shard_counts(targets, 64, 32, 7).collect()}
    slots = mix_slots(targets, 64, 32, 7)
    found = {}
    uses = {}
    for r in slots.collect():
        found[r["shard"], r["_null"], r["_src"]] = found.get((r["shard"], r["_null"], r["_src"]), 0) + 1
        uses.setdefault((r["_null"], r["_src"], r["pass"]), []).append(r["block"])
    assert found == drawn
    assert all(len(b) == len(set(b)) for b in uses.values())  # no block twice in a pass
    plan = slots.select("_src", "block")._jdf.queryExecution().optimizedPlan().toString()
    assert "count" in plan and "before" in plan  # the draw decides the rows, whatever columns are asked for


def test_small_sources_do_not_vanish(spark):
    """A thousand sources of few words: what is taken of each is near its target."""
    rows = [(i, " ".join(["w"] * (i % 40 + 1)), f"s{i % 1000}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(df).join(df.select("doc_id", "source"), "doc_id").collect()
    taken, target, size = {}, {}, {}
    for r in got:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
    assert all(abs(taken[s] - target[s]) <= 1 + size[s] / 32 for s in taken)
    assert abs(sum(taken.values()) - sum(target.values())) < 0.02 * sum(target.values())

import itertools
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlens.llm import segmentation
from adlens.llm.segmentation import Lattice, decoded, encoded, read_vocabulary


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary()


def every(lattice, vocabulary, text, n):
    """All segmentations of a short text, by trying every cut."""
    piece = {p: (i, s) for i, (p, s, _) in enumerate(vocabulary) if p}

    def rest(i):
        if i == len(text):
            return [(0.0, ())]
        out = []
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in piece:
                k, s = piece[text[i:j]]
                out += [(s + t, (k, *ids)) for t, ids in rest(j)]
        if text[i] not in piece:
            spelt = tuple(lattice.byte_ids[b] for b in text[i].encode())
            out += [(sum(lattice.scores[k] for k in spelt) + t, spelt + ids) for t, ids in rest(i + 1)]
        return out

    return sorted(rest(0), key=lambda x: -x[0])[:n]


@pytest.mark.parametrize("text", ["a b.c", "the cat", "m².x", "éa ü ☃\n", "▁x", "a  b\nc", "under", "a_b", "   ", "日本"])
def test_n_best_is_exact(vocabulary, text):
    lattice = Lattice(vocabulary, 4)
    found = lattice.nbest(text)
    want = every(lattice, vocabulary, " " + text, 4)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in want])
    assert len({tuple(ids) for _, ids in found}) == len(found)
    for s, ids in found:
        assert lattice.decode(ids) == text
        assert sum(lattice.scores[k] for k in ids) == pytest.approx(s)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_round_trip(text):
    lattice = Lattice(read_vocabulary(), 2) if not hasattr(test_round_trip, "l") else test_round_trip.l
    test_round_trip.l = lattice
    for _, ids in lattice.nbest(text):
        assert lattice.decode(ids) == text


def test_scores_are_probabilities(vocabulary):
    assert sum(np.exp(s) for p, s, b in vocabulary if p) == pytest.approx(1.0)


def test_many_units(vocabulary):
    """N best over more units than differ: against sums over all choices of the units."""
    lattice = Lattice(vocabulary, 3)
    text = "There under the inter hand " * 20
    units = [lattice.search(u) for u in lattice.units(text)]
    gaps = [[u[0][0] - s for s, _ in u] for u in units]
    top = sum(u[0][0] for u in units)
    costs = sorted([0.0] + [g[1] for g in gaps if len(g) > 1] + [g[2] for g in gaps if len(g) > 2]
                   + [a[1] + b[1] for a, b in itertools.combinations([g for g in gaps if len(g) > 1], 2)])[:3]
    assert [s for s, _ in lattice.nbest(text)] == pytest.approx([top - c for c in costs])


def test_edge_rows(edge, edge_rows):
    out = encoded(edge)
    assert [c for c in edge.columns if c != "text"] == out.columns[:-4]
    rows = out.collect()
    assert len(rows) == len(edge_rows) and all(r["round_trip"] for r in rows)
    back = decoded(out, pieces_col="pieces").select("text").collect()
    assert sorted(r[0] for r in back) == sorted(t or "" for _, t, *_ in edge_rows)


def test_whole_table(small):
    out = encoded(small.select("doc_id", "text"))
    assert out.where("not round_trip or size(pieces) = 0").count() == 0
    assert out.where("nbest_scores[0] < nbest_scores[1]").count() == 0


def test_empty(empty):
    assert encoded(empty).collect() == []


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, pieces string")
    assert encoded(df).columns == ["doc_id", "pieces", "pieces_", "nbest_scores", "nbest_changes", "round_trip"]


def test_every_rank_decodes(spark, small, vocabulary):
    """Ranks 2 and 3 are other segmentations of the same text, each with its score."""
    out = encoded(small.select("doc_id", "text")).cache()
    for rank in (1, 2, 3):
        back = decoded(out, rank=rank).select("doc_id", F.col("text").alias("back")).join(small, "doc_id")
        assert back.where("back is not null and back != coalesce(text, '')").count() == 0
        assert back.where("back is not null").count() > 900
    scores = [s for _, s, _ in vocabulary]
    for r in out.limit(150).collect():
        ranks = [r["pieces"], *[Lattice.changed(r["pieces"], c) for c in r["nbest_changes"]]]
        assert len({tuple(x) for x in ranks}) == len(ranks) == len(r["nbest_scores"])
        assert [sum(scores[k] for k in ids) for ids in ranks] == pytest.approx(r["nbest_scores"])
    out.unpersist()


def test_units_at_once_or_alone(vocabulary, small):
    """The passes over many units at once against the A* search of each."""
    lattice, alone = Lattice(vocabulary, 2), Lattice(vocabulary, 2)
    units = sorted({u for r in small.limit(60).collect() for u in lattice.units(r["text"] or "")})[:1500]
    units += [" ☃x", "éa", " 日本語", "x" * 60, " " * 70]
    lattice.learn(units)
    for u in units:
        k, found = lattice.index[u], alone.search(u)
        assert lattice.best[k] == pytest.approx(found[0][0])
        assert lattice.gap[k] == pytest.approx(found[0][0] - found[1][0] if len(found) > 1 else np.inf)
        own = lattice.ids[lattice.first[k]:lattice.first[k + 1]].tolist()
        assert b"".join(map(lattice.surface.__getitem__, own)) == u.encode()
        assert sum(lattice.scores[i] for i in own) == pytest.approx(found[0][0])


def test_a_long_text_without_spaces(vocabulary):
    """Work in step with the length of a unit."""
    lattice = Lattice(vocabulary, 3)
    text = "abcdefghij" * 20_000
    took = time.process_time()
    found = lattice.nbest(text)
    assert time.process_time() - took < 30 and len(found) == 3
    assert all(lattice.decode(ids) == text for _, ids in found)


def test_what_is_remembered_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(segmentation, "KEPT_UNITS", 10)
    lattice = Lattice(vocabulary, 2)
    texts = ["one two three four five six seven eight nine ten eleven", "other words that are not the same as before at all"] * 3
    whole = Lattice(vocabulary, 2).ranked(texts)
    for t, want in zip(texts, whole):
        (ids, scores, changes), = lattice.ranked([t])
        assert ids.tolist() == want[0].tolist() and scores == pytest.approx(want[1]) and changes == want[2]
        assert len(lattice.index) <= 30

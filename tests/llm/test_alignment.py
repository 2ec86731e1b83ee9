import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from adlens.llm import alignment
from adlens.llm.alignment import BYTE_BPE, PIECE_BPE, Encoders, align, lanes, lockstep, op13_cross_tokenizer_alignment


@pytest.fixture(scope="module")
def encoders():
    return Encoders(open(BYTE_BPE, "rb").read(), open(PIECE_BPE, "rb").read())


def test_both_libraries_give_the_same_ids(small, encoders, edge_rows):
    from tokenizers import Tokenizer

    general = Tokenizer.from_file(BYTE_BPE)
    general.encode_special_tokens = True
    texts = [" " + (r[0] or "") for r in small.select("text").collect()] + [" " + (r[1] or "") for r in edge_rows]
    texts += [" a\u00a0\u2003b  c\t\td\r\n\n e\x85", " I'm you'LL we've 's ''s", " ½²³٣ⅷ x1y2", " \u200b\ufeff\u0301e", " <|endoftext|>!"]
    texts += [" " * 15_000 + "x", "ab" * 9_000 + " " * 30_000 + "y"]
    assert encoders.fast is not None
    assert [encoders.ids_a(t) for t in texts] == [general.encode(t, add_special_tokens=False).ids for t in texts]


def brute(texts, enc):
    """Groups and links by sets of ends and all pairs of a group."""
    out, linked = [], []
    for text in texts:
        a, b = (x[0].tolist() for x in enc.encode([text or ""]))
        ends = [[], []]
        for side, ids, size in ((0, a, enc.size_a), (1, b, enc.size_b)):
            at = 0
            for i in ids:
                at += int(size[i])
                ends[side].append(at)
        groups, part_a, part_b = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            to_a, to_b = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            groups.append((a[part_a:to_a], b[part_b:to_b]))
            part_a, part_b = to_a, to_b
        pairs = Counter((x, y) for p, q in groups for x in p for y in q)
        linked.append(pairs)
        line = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append([len(a), len(b), len(groups), sum(pairs.values()), 0, 0,
                    hashlib.sha256(line.encode()).hexdigest() if groups else ""])
    count = Counter(p for pairs in linked for p in pairs)
    most = defaultdict(int)
    for (x, _), c in count.items():
        most[x] = max(most[x], c)
    for row, pairs in zip(out, linked):
        row[4] = sum(n for p, n in pairs.items() if count[p] == most[p[0]])
        row[5] = sum(n * count[p] for p, n in pairs.items())
    return [tuple(r) for r in out], count


def rows_of(frame):
    return sorted((tuple(r)[1:] for r in frame.collect()))


def test_edge_rows(edge, edge_rows, encoders):
    texts = [r[1] for r in edge_rows if r[0] != 5]
    want, _ = brute(texts, encoders)
    got = align(edge.where("doc_id is null or doc_id != 5"))["documents"]
    assert rows_of(got) == sorted(want)
    nothing = [r for r in want if r[0] == 0]
    assert len(nothing) >= 4 and set(nothing) == {(0, 0, 0, 0, 0, 0, "")}


def test_whole_table_against_brute_force(spark, small, encoders):
    docs = small.orderBy("doc_id").limit(120).collect()
    want, count = brute([r["text"] for r in docs], encoders)
    found = align(spark.createDataFrame(docs, small.schema).repartition(3))
    assert rows_of(found["documents"]) == sorted(want)
    assert {(r["id_a"], r["id_b"]): r["documents"] for r in found["pairs"].collect()} == dict(count)


def test_chunks_change_nothing(small, monkeypatch):
    docs = small.where("doc_id < 60")
    whole = rows_of(align(docs)["documents"])
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(alignment, "LANE", 5)
    assert rows_of(align(docs.repartition(5))["documents"]) == whole


def test_query_has_every_row(spark, small):
    got = op13_cross_tokenizer_alignment(spark, "/root/testdata/sf0.01").toPandas()
    assert sorted(got.doc_id) == sorted(r[0] for r in small.select("doc_id").collect())
    assert (got.n_best <= got.n_links).all() and (got.count_sum >= got.n_links).all()
    assert got.groups_sha256.str.len().isin([0, 64]).all()


def test_special_strings_and_odd_texts(spark, encoders):
    texts = ["<|endoftext|>", "</s> <s><unk>", "▁a", " lead", "tail ", "\n\n\t x", "a b ﬁ ½", "é" * 50,
             " " * 3000, "a" * 3000, "\U0001f600\U0001f600 ok", "\x00 nul"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want, _ = brute(texts, encoders)
    assert rows_of(align(frame)["documents"]) == sorted(want)


def test_lanes_begin_behind_cuts():
    rng = np.random.default_rng(3)
    sizes = [rng.integers(1, 5, n) for n in (4000, 3, 900)]
    ends_a = np.cumsum(np.concatenate(sizes))
    stops = [int(s.sum()) for s in sizes]
    ends_b = np.unique(np.concatenate([rng.integers(1, ends_a[-1], 3000), np.cumsum(stops)]))
    first_a = np.cumsum([0, *map(len, sizes)])
    first_b = np.concatenate(([0], np.searchsorted(ends_b, np.cumsum(stops)) + 1))
    short = lanes(ends_a, ends_b, first_a, first_b, 50)
    assert len(short) > 20
    one = lockstep(ends_a, ends_b, lanes(ends_a, ends_b, first_a, first_b, 10_000))
    assert (lockstep(ends_a, ends_b, short) == one).all()
    assert (np.diff(ends_a[one[:, 1] - 1]) > 0).all()
    assert set(ends_a[one[:, 1] - 1].tolist()) == set(ends_a.tolist()) & set(ends_b.tolist())


def test_empty_table(empty):
    found = align(empty)
    assert found["documents"].collect() == [] and found["pairs"].collect() == []

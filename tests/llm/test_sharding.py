import zlib

from adlens.llm.sharding import op1_sharding, shard_by_bytes


def check(rows, source):
    """Contiguous by id, near equal bytes, gapless slots; brute force on the driver."""
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["size"], r["text_crc32"]) for r in rows if r["doc_id"]) == sorted(
        (True, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in source if i)
    total = sum(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    largest = max(r["size"] for r in rows)
    for s, part in by.items():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / 8) <= largest
    line = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in line]
    assert ids == sorted(ids)
    before = 0
    for r in line:
        assert r["shard"] == before * 8 // total
        before += r["size"]


def test_against_brute_force(spark, small):
    rows = op1_sharding(spark, "/root/testdata/sf0.01")
    assert rows.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    check(rows.collect(), [tuple(r) for r in small.select("doc_id", "text").collect()])


def test_edge_rows(edge, edge_rows):
    rows = shard_by_bytes(edge).collect()
    assert len(rows) == len(edge_rows)
    check(rows, [(i, t) for i, t, *_ in edge_rows])


def test_empty(empty):
    assert shard_by_bytes(empty).collect() == []

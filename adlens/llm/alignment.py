"""Operator 13, alignment of two tokenizers by lockstep vectorised merging.

Each text is encoded by a byte-level BPE (A) and by a piece BPE (B); both
segmentations spell the same bytes, a space and the text. Offsets where a token
of each ends are cuts, and they part the tokens into groups. One state vector
holds the place in A and in B of every document of a run. A step compares the
ends of all current tokens at once: the side that ends first advances; where
both end together, a cut and the group's links are emitted and both advance.
Finished documents are compacted out of the vector. A long text enters as several
lanes, each beginning behind a cut, so that no text keeps the vector alone for long.

Texts are taken in chunks of about ``CHUNK_BYTES``, each encoded in one task. A
chunk keeps its links as (document, place in the chunk's dictionary of id pairs,
occurrences) and is written once. What is counted over the corpus are the
dictionaries, in which a pair stands once a chunk however many documents hold it,
so nothing the size of all links is shuffled, and no pair is hot. The highest
count of each A id (a table bounded by A's vocabulary) is broadcast; the counts
of a chunk's pairs go back to the chunk, which sums them up for its documents.

The vocabulary files are read by the driver from paths that are parameters and
are broadcast (bounded by the vocabularies). Nothing is trained.

Defined cases: NULL and empty texts, and texts that one of the tokenizers does
not spell byte by byte (A's or B's bytes are not a space and the text), have no
tokens: all numbers are 0 and ``groups_sha256`` is ''. Special tokens' strings in
a text are plain text. Ties for the highest count all count as best. Repeated
rows count each as a document. A NULL id stays NULL. An empty table gives an empty
result. Other columns are ignored. Memory is bounded by a chunk or the longest text,
and by the distinct id pairs of the largest group.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import stored, table

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁"
# Fixed value: how byte-level vocabularies of this kind part a text ahead of merging.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_TEXT = 20_000  # characters; in longer texts, where they have a long run, the general library applies A
LONG_RUN = re.compile(r"(?:^|\s)\S{1000}|\s{200}")
CHUNK_BYTES = 4 << 20
LANE = 1024       # tokens of A after which a long text goes on in a lane of its own
EXPANDED = 4096   # links up to which a group's pairs are written out one by one
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


# -- the two vocabularies -------------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """Letter to byte in byte-level vocabularies: printable bytes stand for themselves, others follow at 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoders:
    """Both tokenizers with the bytes of each id, made once in a task from the files' contents.

    Where A's merges are in the order of its ids (the file says so), ``tiktoken`` applies
    the same vocabulary several times faster; texts with very long runs, and other
    vocabularies, go to ``tokenizers``. The ids are the same.
    """

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        import sentencepiece

        letters, spec = byte_letters(), json.loads(byte_bpe)
        plain, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_a = [b""] * (max([*plain.values(), *special.values()]) + 1)
        for token, i in plain.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        ranks = {x: i for i, x in enumerate(self.bytes_a) if x}
        for token, i in special.items():
            self.bytes_a[i] = token.encode()
        self.file_a, self.general, self.fast = byte_bpe, None, None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pre, first = spec["pre_tokenizer"], len(plain) - len(pairs)
        if (spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
                and all(plain.get("".join(p)) == first + k for k, p in enumerate(pairs))):
            import tiktoken

            self.fast = tiktoken.Encoding("a", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        self.bytes_b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace(SPACE_MARK, " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        # an id as text with the sign behind it: within a side, before the links' other side, behind the group
        self.texts = [f"{i}{sign}" for n, signs in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                      for sign in signs for i in range(n)]

    def ids_a(self, text: str) -> list[int]:
        if self.fast and (len(text) <= LONG_TEXT or not LONG_RUN.search(text)):
            return self.fast.encode_ordinary(text)
        if not self.general:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
            from tokenizers import Tokenizer

            self.general = Tokenizer.from_buffer(self.file_a)
            self.general.encode_special_tokens = True
        return self.general.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of A and of B, int32 for each text; both empty where a side does not spell the text."""
        none = np.zeros(0, np.int32)
        a, b = [], []
        for at in range(0, len(texts), 64):  # few at once: lists of ids take much room
            some = texts[at:at + 64]
            for text, pieces in zip(some, self.b.encode(some, num_threads=1)):
                raw, ids = b" " + text.encode(), self.ids_a(" " + text) if text else []
                spelt = text and (b"".join(map(self.bytes_a.__getitem__, ids)) == raw
                                  and b"".join(map(self.bytes_b.__getitem__, pieces)) == raw)
                a.append(np.array(ids, np.int32) if spelt else none)
                b.append(np.array(pieces, np.int32) if spelt else none)
        return a, b


# -- lockstep merging ------------------------------------------------------------------

def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
          lane: int | None = None) -> np.ndarray:
    """Rows ``a0, a1, b0, b1``: the token ranges that the lockstep runs through, documents or parts of long ones.

    ``first_a`` and ``first_b`` are where each document's tokens begin, and at the end how many there are.
    """
    lane = lane or LANE
    a0, b0 = [first_a[:-1]], [first_b[:-1]]
    n = np.diff(first_a)
    for d in np.flatnonzero(n > 2 * lane).tolist():
        at, stop = int(first_a[d]) + lane, int(first_a[d + 1]) - lane
        while at < stop:
            ends = ends_a[at:min(at + 64, stop)]
            there = np.searchsorted(ends_b, ends)
            both = np.flatnonzero(ends_b[there] == ends)
            if not len(both):
                at += len(ends)
                continue
            a0.append(np.array([at + both[0] + 1]))
            b0.append(np.array([there[both[0]] + 1]))
            at += int(both[0]) + 1 + lane
    a0, b0 = np.sort(np.concatenate(a0)), np.sort(np.concatenate(b0))
    out = np.stack([a0, np.append(a0[1:], first_a[-1]), b0, np.append(b0[1:], first_b[-1])], axis=1)
    return out[out[:, 0] < out[:, 1]]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Groups as rows ``a0, a1, b0, b1`` (token ranges), in order of place."""
    if not len(ranges):
        return np.zeros((0, 4), np.int64)
    a, stop, b = (ranges[:, k].copy() for k in (0, 1, 2))
    from_a, from_b = a.copy(), b.copy()
    found = []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        step_a, step_b = end_a <= end_b, end_b <= end_a
        a += step_a
        b += step_b
        if cut.any():
            found.append(np.stack([from_a[cut], a[cut], from_b[cut], b[cut]], axis=1))
            from_a, from_b = np.where(cut, a, from_a), np.where(cut, b, from_b)
            going = a < stop
            if not going.all():  # compact: finished documents leave the vector
                a, b, stop, from_a, from_b = (x[going] for x in (a, b, stop, from_a, from_b))
    groups = np.concatenate(found)
    return groups[np.argsort(groups[:, 0], kind="stable")]


def link_pairs(groups: np.ndarray, doc: np.ndarray, a: np.ndarray, b: np.ndarray, width: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, id pair, occurrences) of the links, each pair once a document and in order of both.

    ``doc``: the document of each group; a pair is ``A id * width + B id``.
    """
    n_a, n_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    small = n_a * n_b <= EXPANDED
    g, d, links = groups[small], doc[small], (n_a * n_b)[small]
    owner = np.repeat(np.arange(len(g)), links)
    inside = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
    at_a = g[owner, 0] + inside // n_b[small][owner]
    at_b = g[owner, 2] + inside % n_b[small][owner]
    bits = int(width * (int(a.max(initial=0)) + 1)).bit_length()
    if int(doc.max(initial=0)).bit_length() + bits > 63:
        raise ValueError("ids and documents of a chunk do not fit 63 bits")
    keys = np.sort((d[owner] << bits) | (a[at_a] * width + b[at_b]))
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    keys, times = [keys[first]], [np.diff(first, append=len(keys))]
    for k in np.flatnonzero(~small).tolist():  # by distinct ids, not by occurrences
        ids_a, times_a = np.unique(a[groups[k, 0]:groups[k, 1]], return_counts=True)
        ids_b, times_b = np.unique(b[groups[k, 2]:groups[k, 3]], return_counts=True)
        keys.append((int(doc[k]) << bits) | (ids_a[:, None] * width + ids_b).ravel())
        times.append((times_a[:, None] * times_b).ravel())
    keys, times = np.concatenate(keys), np.concatenate(times)
    if not small.all():
        keys, at = np.unique(keys, return_inverse=True)
        summed = np.zeros(len(keys), np.int64)
        np.add.at(summed, at, times)
        times = summed
    return keys >> bits, keys & ((1 << bits) - 1), times


def group_digests(groups: np.ndarray, doc: np.ndarray, n_docs: int, a: np.ndarray, b: np.ndarray,
                  enc: Encoders) -> list[str]:
    """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; '' without groups."""
    n_a, n_b = groups[:, 1] - groups[:, 0], groups[:, 3] - groups[:, 2]
    entry = np.empty(len(a) + len(b), np.int64)  # places in ``enc.texts``
    last_a, last_b = np.zeros(len(a), np.int64), np.full(len(b), 2 * len(enc.bytes_a))
    last_a[groups[:, 1] - 1] = len(enc.bytes_a)
    last_b[groups[:, 3] - 1] += len(enc.bytes_b)
    entry[np.arange(len(a)) + np.repeat(groups[:, 2], n_a)] = a + last_a
    entry[np.arange(len(b)) + np.repeat(groups[:, 1], n_b)] = b + last_b
    ends = np.zeros(n_docs, np.int64)
    np.maximum.at(ends, doc, groups[:, 1] + groups[:, 3])
    out, at = [], 0
    for end in ends.tolist():
        if end > at:
            out.append(hashlib.sha256("".join(map(enc.texts.__getitem__, entry[at:end].tolist()))[:-1].encode()).hexdigest())
            at = end
        else:
            out.append("")
    return out


def aligned(texts: list[str | None], enc: Encoders) -> dict:
    """A chunk of texts: numbers and digest by document, dictionary of id pairs, and links into it."""
    ids_a, ids_b = enc.encode([t or "" for t in texts])
    count_a, count_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64) for ids in (ids_a, ids_b))
    del ids_a, ids_b
    first_a, first_b = (np.concatenate(([0], np.cumsum(c))) for c in (count_a, count_b))
    # ends over all texts in a row: texts spell the same bytes on both sides, so offsets agree
    ends_a, ends_b = np.cumsum(enc.size_a[a]), np.cumsum(enc.size_b[b])
    groups = lockstep(ends_a, ends_b, lanes(ends_a, ends_b, first_a, first_b))
    doc = np.searchsorted(first_a, groups[:, 0], "right") - 1
    n = len(texts)
    links = (groups[:, 1] - groups[:, 0]) * (groups[:, 3] - groups[:, 2])
    n_links = np.zeros(n, np.int64)
    np.add.at(n_links, doc, links)
    owner, pairs, times = link_pairs(groups, doc, a, b, len(enc.bytes_b))
    known, at, holders = np.unique(pairs, return_inverse=True, return_counts=True)
    return {"n_a": count_a, "n_b": count_b, "n_groups": np.bincount(doc, minlength=n), "n_links": n_links,
            "sha": group_digests(groups, doc, n, a, b, enc),
            "known": known, "holders": holders, "links": np.bincount(owner, minlength=n), "at": at, "times": times}


# -- over the corpus -------------------------------------------------------------------

def packed(x: np.ndarray, kind=np.uint32) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x, kind).tobytes())


def unpacked(x: bytes, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind).astype(np.int64)


CHUNK_SCHEMA = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                "n_links array<long>, sha array<string>, known binary, holders binary, links binary, at binary, times binary")


def chunk_rows(docs: DataFrame, byte_bpe: bytes, piece_bpe: bytes) -> DataFrame:
    """A row for each chunk of ``doc_id, text``: its documents, its dictionary and its links."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_bpe, piece_bpe))
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), longs, longs, longs, longs, longs, pa.list_(pa.string()), *[pa.binary()] * 5]
    names = [c.split()[0] for c in CHUNK_SCHEMA.split(", ")]

    def row(number: int, ids: list, texts: list, enc: Encoders) -> pa.RecordBatch:
        x = aligned(texts, enc)
        chunk = (TaskContext.get().partitionId() << 32) | number
        values = [chunk, ids, *[x[k].tolist() for k in NUMBERS[:4]], x["sha"], packed(x["known"], np.uint64),
                  *[packed(x[k]) for k in ("holders", "links", "at")], packed(x["times"], np.uint64)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, ids, texts, held, number = None, [], [], 0, 0
        for batch in batches:
            enc = enc or Encoders(*shared.value)
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                ids.append(batch.column(0)[k].as_py())
                texts.append(text)
                held += len(text or "") + 64
                if held >= CHUNK_BYTES:
                    yield row(number, ids, texts, enc)
                    ids, texts, held, number = [], [], 0, number + 1
        if ids:
            yield row(number, ids, texts, enc)

    return docs.mapInArrow(run, CHUNK_SCHEMA)


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """``chunk, pair, holders``: the chunks' dictionaries, a row for each entry."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pair = unpacked(batch.column(1)[k].as_py(), np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), batch.column(0)[k].as_py(), np.int64)), pa.array(pair),
                     pa.array(unpacked(batch.column(2)[k].as_py()))], names=["chunk", "pair", "holders"])

    return chunks.select("chunk", "known", "holders").mapInArrow(run, "chunk long, pair long, holders long")


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
          id_col: str = "doc_id", text_col: str = "text") -> dict[str, DataFrame]:
    """``documents``: a row for each row of ``docs`` with its numbers and digest; ``pairs``:
    ``id_a, id_b, documents``, the linked id pairs of the corpus with the documents that hold them."""
    with open(byte_bpe, "rb") as f, open(piece_bpe, "rb") as g:
        files = f.read(), g.read()
    width = len(Encoders(*files).bytes_b)
    chunks = stored(chunk_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                               *files), "align-chunks")
    entries = chunk_pairs(chunks)
    counts = stored(entries.groupBy("pair").agg(F.sum("holders").alias("count")), "align-counts")
    id_a = F.expr(f"pair div {width}")
    highest = counts.groupBy(id_a.alias("id_a")).agg(F.max("count").alias("most"))  # a row for each id of A at most
    marked = counts.withColumn("id_a", id_a).join(F.broadcast(highest), "id_a").select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best"))
    known = entries.select("chunk", "pair").join(marked, "pair")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        order = np.argsort(right.column("pair").to_numpy(), kind="stable")  # the dictionary's order
        count = right.column("count").to_numpy()[order]
        best = right.column("best").to_numpy().astype(bool)[order]
        at, times = unpacked(row["at"]), unpacked(row["times"], np.uint64)
        n = len(row["doc_id"])
        owner = np.repeat(np.arange(n), unpacked(row["links"]))
        n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(n_best, owner, times * best[at])
        np.add.at(count_sum, owner, times * count[at])
        arrays = [pa.array(row[c], pa.int64()) for c in ("doc_id", *NUMBERS[:4])]
        return pa.table([*arrays, pa.array(n_best), pa.array(count_sum), pa.array(row["sha"], pa.string())],
                        names=["doc_id", *NUMBERS, "groups_sha256"])

    schema = ", ".join(["doc_id long", *[f"{c} long" for c in NUMBERS], "groups_sha256 string"])
    rows = chunks.drop("known", "holders").groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(summed, schema)
    pairs = counts.select(id_a.alias("id_a"), F.expr(f"pair % {width}").alias("id_b"), F.col("count").alias("documents"))
    return {"documents": rows, "pairs": pairs}


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with the alignment of their byte-level and their piece tokens."""
    return align(table(spark, sf_dir, "documents"))["documents"]

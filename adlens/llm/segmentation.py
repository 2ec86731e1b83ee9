"""Operator 6, SentencePiece encoding and decoding by N-best segmentation.

The pieces of a public SentencePiece vocabulary span a lattice over the text;
a piece's log probability follows Zipf's law in its rank. A forward Viterbi
pass gives the best score from the start to every place, which is the exact
rest cost of a search from the end: backward A* over the lattice then yields
the N best segmentations in order. Characters without a piece are spelt in
byte pieces, a space is the vocabulary's space mark, and one space is put
ahead of the text, so decoding gives back every text exactly.

No piece holds a space behind another character, a newline, or (but for the
characters in ``Lattice.joined``) a word character ahead of another kind, so a
text's lattice falls apart at these places into short units. The Viterbi pass
runs over all new units of a run of texts at once, unit by unit of equal length
and place by place, in both directions: from the start it gives the best
segmentation, and with the pass from the end the gap to the next best. The N best
of the text are the N best sums over its units, in which only the N - 1 units of
the smallest gaps can differ from their best, so the A* search runs on these. A
segmentation of rank 2 and on is given by its score and the units in which it
differs from the best: where their pieces begin, how many there are, and the
pieces in their place.

A task remembers up to ``KEPT_UNITS`` units and nothing outlives it.

The vocabulary is read by the driver from a path that is a parameter and
broadcast (bounded by the vocabulary). Encoding is a map over Arrow batches;
memory is bounded by the longest text.

Defined cases: NULL and empty texts have no pieces, score 0 and decode to the
empty text; equal scores keep the order in which the search finds them, which
depends on the text alone; where a text has fewer than N segmentations, all
are given; repeated rows are encoded each for itself; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from adlens.llm.common import free_name, table
from adlens.llm.words import runs

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
KEPT_UNITS = 150_000
LONG_UNIT = 48  # characters; longer units go through the lattice one by one
BASE = np.uint64(0x9E3779B97F4A7C15)  # of the hash of a run of characters
SPACE_MARK = "▁"
RUN_CHARS = 2_000_000


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float, int]]:
    """(surface, log probability, byte value or -1) by id; control pieces have no surface."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    plain = [i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    # the vocabulary's scores only rank its pieces; by Zipf, p is about 1 / rank
    rank = {i: r for r, i in enumerate(sorted(plain, key=lambda i: (-sp.get_score(i), i)), 3)}
    norm = math.log(sum(1 / r for r in rank.values()))

    def log_p(r: int) -> float:
        """In steps of 2^-20, so that sums are exact and equal segmentations tie, in whatever order they are added."""
        return round((-math.log(r) - norm) * 2 ** 20) / 2 ** 20

    least = log_p(len(rank) + 3)
    out = []
    for i in ids:
        if sp.is_byte(i):
            out.append(("", least - 1, int(sp.id_to_piece(i)[3:5], 16)))
        elif i in rank:
            out.append((sp.id_to_piece(i).replace(SPACE_MARK, " "), log_p(rank[i]), -1))
        else:
            out.append(("", 0.0, -1))
    return out


class Lattice:
    """N-best segmentation of units, with the units seen so far remembered."""

    def __init__(self, vocabulary: list[tuple[str, float, int]], n: int):
        self.n = n
        self.byte_ids = {b: i for i, (_, _, b) in enumerate(vocabulary) if b >= 0}
        self.scores = [s for _, s, _ in vocabulary]
        self.surface = [bytes([b]) if b >= 0 else p.encode() for p, _, b in vocabulary]
        self.pieces = {p: (i, s) for i, (p, s, _) in enumerate(vocabulary) if p}
        if any(" " in p.lstrip(" ") or "\n" in p for p in self.pieces):
            raise ValueError("pieces across spaces or newlines are not supported")
        self.longest = max(map(len, self.pieces), default=1)
        self.joined = sorted({p[m.start()] for p in self.pieces for m in re.finditer(r"\w(?=[^\w ])", p)})
        self.fine = re.compile(r"\n| *[^\w\n ]*\w+| *[^\w\n ]+| +")
        self.coarse = re.compile(r"\n| *[^\n ]+| +")
        # pieces by the hash of their characters
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.hash_ids = np.array([i for i, _ in self.pieces.values()], np.int32)[order]
        self.hash_scores = np.array([s for _, s in self.pieces.values()])[order]
        self.byte_score = self.scores[self.byte_ids[0]] if self.byte_ids else -math.inf
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.further: dict[str, list[tuple[float, list[int]]]] = {}
        self.ids = np.zeros(0, np.int32)      # of the best segmentations, one behind the other
        self.first = np.zeros(1, np.int64)    # where each unit's ids begin
        self.best, self.gap = np.zeros(0), np.zeros(0)

    def units(self, text: str) -> list[str]:
        whole = any(c in text for c in self.joined)
        return (self.coarse if whole else self.fine).findall(" " + text)

    # -- one unit ------------------------------------------------------------------------

    def forward(self, unit: str) -> tuple[list[tuple], list[float]]:
        """The unit's edges (start, end, score, pieces) by end, and the best score from the start to each place."""
        size, get, longest = len(unit), self.pieces.get, self.longest
        ahead = [0.0, *[-math.inf] * size]
        edges: list[tuple] = []
        for j in range(1, size + 1):
            for i in range(max(0, j - longest), j):
                hit = get(unit[i:j])
                if hit is not None:
                    edges.append((i, j, hit[1], (hit[0],)))
                    if ahead[i] + hit[1] > ahead[j]:
                        ahead[j] = ahead[i] + hit[1]
                elif i == j - 1:
                    spelt = tuple(self.byte_ids[b] for b in unit[i].encode())
                    s = sum(self.scores[k] for k in spelt)
                    edges.append((i, j, s, spelt))
                    if ahead[i] + s > ahead[j]:
                        ahead[j] = ahead[i] + s
        return edges, ahead

    def search(self, unit: str, n: int | None = None) -> list[tuple[float, list[int]]]:
        """The unit's N best segmentations, best first, by A* from its end."""
        edges, ahead = self.forward(unit)
        ends: list[list[tuple]] = [[] for _ in ahead]
        for e in edges:
            ends[e[1]].append(e)
        found: list[tuple[float, list[int]]] = []
        heap: list = [(-ahead[-1], 0, len(unit), 0.0, None)]
        made = 0
        while heap and len(found) < (n or self.n):
            _, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids.extend(path[0])
                    path = path[1]
                found.append((behind, ids))
                continue
            for start, _, s, piece in ends[at]:
                made += 1
                total = behind + s
                heapq.heappush(heap, (-(total + ahead[start]), -made, start, total, (piece, path)))
        return found

    def others(self, unit: str) -> list[tuple[float, list[int]]]:
        """(loss against the best, ids) of the unit's further segmentations."""
        known = self.further.get(unit)
        if known is None:
            found = self.search(unit)
            if any(b"".join(map(self.surface.__getitem__, ids)) != unit.encode() for _, ids in found):
                raise ValueError("a segmentation does not spell its unit")
            k = self.index[unit]
            own = self.ids[self.first[k]:self.first[k + 1]].tolist()  # of several best ones, that which is remembered
            known = [(found[0][0] - s, ids) for s, ids in found if ids != own][:self.n - 1]
            if len(self.further) < KEPT_UNITS:
                self.further[unit] = known
        return known

    # -- many units at once -----------------------------------------------------------------

    @staticmethod
    def _hash(text: str) -> int:
        """The hash of a run of characters, as ``_edges`` makes it from the left."""
        h, mask = 0, (1 << 64) - 1
        for c in text:
            h = (h + ord(c) + 1) * int(BASE) & mask
            h ^= h >> 29
        return h

    def _edges(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the pieces that begin at each place, by their length less 1 (-inf and -1: none;
        id -2: one character in byte pieces), for units of one length."""
        size, most = len(units[0]), min(self.longest, len(units[0]))
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(units), size)
        scores = np.full((most, len(units), size), -np.inf)
        ids = np.full((most, len(units), size), -1, np.int32)
        h = np.zeros((len(units), size), np.uint64)  # of the characters from each place on
        for k in range(most):
            n = size - k
            h = (h[:, :n] + codes[:, k:].astype(np.uint64) + np.uint64(1)) * BASE
            h ^= h >> np.uint64(29)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            scores[k, :, :n][hit] = self.hash_scores[at[hit]]
            ids[k, :, :n][hit] = self.hash_ids[at[hit]]
        missing = ids[0] < 0
        width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        scores[0][missing] = width[missing] * self.byte_score
        ids[0][missing] = -2
        return scores, ids

    def _learn_equal(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best score, gap to the next best, number of ids and all ids of the best, for units of one length."""
        n, size = len(units), len(units[0])
        scores, ids = self._edges(units)
        most = len(scores)
        ahead = np.full((n, size + 1), -np.inf)
        came = np.zeros((n, size + 1), np.int64)
        ahead[:, 0] = 0
        for j in range(1, size + 1):
            for k in range(min(most, j) - 1, -1, -1):  # of equal ones the longest stays
                now = ahead[:, j - 1 - k] + scores[k, :, j - 1 - k]
                better = now > ahead[:, j]
                ahead[better, j] = now[better]
                came[better, j] = k + 1
        behind = np.full((n, size + 1), -np.inf)
        behind[:, size] = 0
        for i in range(size - 1, -1, -1):
            for k in range(min(most, size - i)):
                np.maximum(behind[:, i], behind[:, i + 1 + k] + scores[k, :, i], out=behind[:, i])
        length = np.zeros((n, size), np.int64)  # of the best's piece that begins here
        at, rows = np.full(n, size), np.arange(n)
        while len(rows):
            back = came[rows, at[rows]]
            at[rows] -= back
            length[rows, at[rows]] = back
            rows = rows[at[rows] > 0]
        second = np.full(n, -np.inf)
        for k in range(most):
            through = ahead[:, :size - k] + scores[k, :, :size - k] + behind[:, k + 1:]
            through[length[:, :size - k] == k + 1] = -np.inf
            np.maximum(second, through.max(axis=1), out=second)
        unit, place = np.nonzero(length)
        return ahead[:, -1], ahead[:, -1] - second, np.bincount(unit, minlength=n), ids[length[unit, place] - 1, unit, place]

    def learn(self, units: list[str]) -> None:
        """Remember the best segmentation of new units, and the gap to the next."""
        by_size: dict[int, list[str]] = {}
        for u in units:
            by_size.setdefault(len(u) if len(u) <= LONG_UNIT else 0, []).append(u)
        bests, gaps, counts, ids = [self.best], [self.gap], [], [self.ids]
        for size, some in by_size.items():
            if not size:  # long ones
                found = [self.search(u, 2) for u in some]
                bests.append(np.array([f[0][0] for f in found]))
                gaps.append(np.array([f[0][0] - f[1][0] if len(f) > 1 else math.inf for f in found]))
                counts.append(np.array([len(f[0][1]) for f in found]))
                ids.append(np.array([k for f in found for k in f[0][1]], np.int32))
            for part in (some[k:k + 4096] for k in range(0, len(some), 4096) if size):
                best, gap, count, own = self._learn_equal(part)
                if (own == -2).any():  # characters in byte pieces
                    spelt = iter([[self.byte_ids[b] for b in c.encode()] for u in part for c in u if c not in self.pieces])
                    owner = np.repeat(np.arange(len(part)), count)
                    wide = [next(spelt) if k == -2 else [k] for k in own.tolist()]
                    count = np.bincount(np.repeat(owner, [len(w) for w in wide]), minlength=len(part))
                    own = np.array([k for w in wide for k in w], np.int32)
                bests.append(best)
                gaps.append(gap)
                counts.append(count)
                ids.append(own)
        for some in by_size.values():
            for u in some:
                self.index[u] = len(self.index)
        self.best, self.gap, self.ids = np.concatenate(bests), np.concatenate(gaps), np.concatenate(ids)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate(counts))]) if counts else self.first

    # -- texts ----------------------------------------------------------------------------------

    def ranked(self, texts: list[str]) -> list[tuple[np.ndarray, list[float], list[list[tuple[int, int, list[int]]]]]]:
        """For each text: ids of the best segmentation, scores of the N best, and for rank 2 and on the
        changes against the best, as (where, how many ids go, ids that come)."""
        split = [self.units(t) if t else [] for t in texts]
        if len(self.index) > KEPT_UNITS:
            self.forget()
        new = list({u: None for units in split for u in units if u not in self.index})
        if new:
            self.learn(new)
        out = []
        for units in split:
            at = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
            n = self.first[at + 1] - self.first[at]
            ends = np.cumsum(n)
            place = np.repeat(self.first[at] - ends + n, n) + np.arange(n.sum())
            total = float(self.best[at].sum())
            scores, changes = [total], []
            if self.n > 1 and units:
                # only the units of the N - 1 smallest first gaps can differ from their best
                gaps = self.gap[at]
                near = (np.argsort(gaps, kind="stable")[:self.n - 1] if len(gaps) <= 64 else
                        self._least(gaps, self.n - 1)).tolist()
                choices = [[(0.0, []), *self.others(units[u])] for u in near]
                heap, seen = [(0.0, (0,) * len(choices))], set()
                while heap and len(scores) < self.n:
                    cost, pick = heapq.heappop(heap)
                    if pick in seen:
                        continue
                    seen.add(pick)
                    if any(pick):
                        scores.append(total - cost)
                        changes.append(sorted((int(ends[u] - n[u]), int(n[u]), c[p][1])
                                              for u, c, p in zip(near, choices, pick) if p))
                    for k, c in enumerate(choices):
                        if pick[k] + 1 < len(c):
                            up = (*pick[:k], pick[k] + 1, *pick[k + 1:])
                            heapq.heappush(heap, (sum(choices[x][p][0] for x, p in enumerate(up)), up))
            out.append((self.ids[place], scores, changes))
        return out

    @staticmethod
    def changed(best: list[int], changes: list[tuple[int, int, list[int]]]) -> list[int]:
        """The ids of a further segmentation: the best's with its changes."""
        ids, at = [], 0
        for where, drop, come in changes:
            ids += best[at:where]
            ids += come
            at = where + drop
        return ids + best[at:]

    def nbest(self, text: str) -> list[tuple[float, list[int]]]:
        """(score, ids) of the text's N best segmentations, best first."""
        (best, scores, changes), = self.ranked([text])
        ids = best.tolist()
        return list(zip(scores, [ids, *[self.changed(ids, c) for c in changes]]))

    @staticmethod
    def _least(gaps: np.ndarray, n: int) -> np.ndarray:
        some = np.argpartition(gaps, n)[:n]
        edge = gaps[some].max()
        some = np.flatnonzero(gaps <= edge)  # all that tie, so that the first ones win
        return some[np.argsort(gaps[some], kind="stable")][:n]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a segmentation, without the space put ahead of it."""
        return b"".join(map(self.surface.__getitem__, ids))[1:].decode()

    def spells(self, text: str, best: list[int], changes: list[list[tuple[int, int, list[int]]]]) -> bool:
        """Whether the best segmentation and every further one decode to the text."""
        if self.decode(best) != text:
            return False
        bytes_of = self.surface.__getitem__
        return all(b"".join(map(bytes_of, best[at:at + drop])) == b"".join(map(bytes_of, come))
                   for change in changes for at, drop, come in change)


CHANGE = StructType([StructField("at", IntegerType()), StructField("drop", IntegerType()), StructField("ids", ArrayType(IntegerType()))])
ARROW_CHANGE = pa.struct([("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])


def encoded(docs: DataFrame, n: int = 3, vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``pieces``, ``nbest_scores``, ``nbest_changes``, ``round_trip`` added.

    ``pieces`` are the ids of the best segmentation, ``nbest_scores`` the scores of the
    N best, ``nbest_changes`` for rank 2 and on how it differs from the best (``at``,
    ``drop``, ``ids``: from place ``at`` on, ``drop`` ids give way to ``ids``), and
    ``round_trip`` tells that all of them decode to the text. Where ``docs`` has a column
    of one of these names, the new one gets underscores at its end.
    """
    pieces = read_vocabulary(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    others = [c for c in docs.columns if c != text_col]
    added = [free_name(docs, x) for x in ("pieces", "nbest_scores", "nbest_changes", "round_trip")]
    rows = docs.select(*others, F.col(text_col))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = None
        for b in batches:
            lattice = lattice or Lattice(shared.value, n)
            at = 0
            for texts in runs(b.column(len(others)).to_pylist(), lambda t: len(t or "") + 100, RUN_CHARS):
                found = lattice.ranked([t or "" for t in texts])
                same = [lattice.spells(t or "", best.tolist(), changes) for t, (best, _, changes) in zip(texts, found)]
                lengths = np.cumsum([0, *[len(best) for best, _, _ in found]])
                part = b.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(others)],
                     pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate([f[0] for f in found]), pa.int32())),
                     pa.array([f[1] for f in found], pa.list_(pa.float64())),
                     pa.array([[[{"at": a, "drop": d, "ids": c} for a, d, c in change] for change in f[2]] for f in found],
                              pa.list_(pa.list_(ARROW_CHANGE))),
                     pa.array(same)],
                    names=[*others, *added])
                at += len(texts)

    schema = StructType([*rows.schema.fields[:-1], StructField(added[0], ArrayType(IntegerType())),
                         StructField(added[1], ArrayType(DoubleType())), StructField(added[2], ArrayType(ArrayType(CHANGE))),
                         StructField(added[3], BooleanType())])
    return rows.mapInArrow(run, schema)


def decoded(rows: DataFrame, vocabulary: str = VOCABULARY, pieces_col: str = "pieces", rank: int = 1,
            changes_col: str = "nbest_changes") -> DataFrame:
    """``rows`` with ``text`` decoded from the segmentation of ``rank``; NULL where there is none."""
    shared = rows.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    out = free_name(rows, "text")
    k = rows.columns.index(pieces_col)
    change = rows.columns.index(changes_col) if rank > 1 else None
    names = [*rows.columns, out]

    def ids_of(best: list | None, changes: list | None) -> list | None:
        if best is None or rank == 1:
            return best
        if len(changes or []) < rank - 1:
            return None
        return Lattice.changed(best, [(c["at"], c["drop"], c["ids"]) for c in changes[rank - 2]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(shared.value, 1)
        for b in batches:
            best = b.column(k).to_pylist()
            ids = map(ids_of, best, b.column(change).to_pylist() if rank > 1 else best)
            texts = [None if x is None else lattice.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=names)

    schema = StructType([*rows.schema.fields, StructField(out, StringType())])
    return rows.mapInArrow(run, schema)


def op6_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` as pieces, with their three best segmentations and these's scores."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs).select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces",
                                "nbest_scores", "nbest_changes", "round_trip")

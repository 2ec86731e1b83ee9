"""Operator 5, language identification by word-first backoff.

A word the model knows scores its log frequency in each language. A word it
has not seen falls back to its character n-grams (with marks for the word's
ends): the longest order of which the model knows any n-gram, else the next
shorter one. A text's score is the sum over its words; the language of the
highest score wins.

The model is fitted on a documented, bounded sample of labelled rows
(``sample_bytes`` of text for each language on average, drawn by a hash of id and text,
one row at least; all
rows where there are fewer) and keeps words and n-grams seen ``min_count``
times or more, so its size is bounded by the sample's. Of more than
``max_langs`` languages those of the most text are learned. Counting runs as a Spark aggregation; the finished
model is broadcast. Every row is then scored, whole texts, in Arrow batches.

Defined cases: NULL text and text without a letter are ``und`` with score 0;
rows of NULL or empty text or NULL lang are not learned from; equal scores go
to the language first in code point order; without any learned language all
texts are ``und``; a NULL id counts as an empty one in the fold; repeated rows
are scored each for itself; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import table

WORDS = re.compile(r"[^\W\d_]+")
ORDERS = (5, 4, 3, 2, 1)
KEPT_WORDS = 200_000  # unseen words remembered by one Python worker between texts


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies by language: ``words`` and ``grams[n]`` map a key to a row."""

    def __init__(self, langs: list[str], counts: dict[int, dict[str, dict[int, int]]]):
        self.langs = langs
        self.rows: list[np.ndarray] = []
        self.index: dict[int, dict[str, int]] = {}
        for n in (0, *ORDERS):
            found = counts.get(n, {})
            self.index[n] = {}
            table_n = np.zeros((len(found), len(langs)))
            for k, (key, by_lang) in enumerate(found.items()):
                self.index[n][key] = k
                for at, c in by_lang.items():
                    table_n[k, at] = c
            table_n += 0.1
            self.rows.append(np.log(table_n / table_n.sum(axis=0, keepdims=True)) if len(found) else table_n)


class Scorer(dict):
    """Word to row of ``matrix``; a missing word is scored by backoff and remembered."""

    def __init__(self, model: Model):
        super().__init__(model.index[0])
        self.model, self.known = model, len(model.index[0])
        self.matrix = np.concatenate([model.rows[0], np.zeros((1024, len(model.langs)))])
        self.used, self.unseen = self.known, []

    def __missing__(self, word: str) -> int:
        row = np.zeros(len(self.model.langs))
        for at, n in enumerate(ORDERS, 1):
            index = self.model.index[n]
            hits = [index[g] for g in grams(word, n) if g in index]
            if hits:
                row = self.model.rows[at][hits].mean(axis=0)
                break
        if self.used == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        k = self[word] = self.used
        self.matrix[k] = row
        self.used += 1
        self.unseen.append(word)
        return k

    def predict(self, text: str | None) -> tuple[str, float]:
        found = WORDS.findall((text or "").lower())
        if not found or not self.model.langs:
            return "und", 0.0
        ids = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        total = self.matrix[ids].sum(axis=0)
        best = int(total.argmax())
        share = np.exp(total - total[best])
        if len(self.unseen) > KEPT_WORDS:  # forget, so that memory stays bounded
            for w in self.unseen:
                del self[w]
            self.used, self.unseen = self.known, []
        return self.model.langs[best], float(1.0 / share.sum())


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_bytes: int = 4_000_000, min_count: int = 3, max_langs: int = 400) -> Model:
    """The model of rows with text and lang, from a bounded sample of each language.

    Of more than ``max_langs`` languages those of the most text are learned.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    # rows in order of a hash of id and text: the first ones of a language, as many as the bound
    # lets in on average, and its very first in any case
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), "text", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.withColumn("draw", draw)
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("b"), F.min("draw").alias("first")).orderBy(
        F.desc("b"), "lang").limit(max_langs).collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return Model([], {})
    upto = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], max(min(1.0, sample_bytes / r["b"]), r["first"]))])
    sample = rows.where(F.col("draw") <= upto[F.col("lang")])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen.setdefault(lang, Counter()).update(WORDS.findall(text.lower()))
        for lang, words in seen.items():
            by_n: dict[int, Counter] = {0: words, **{n: Counter() for n in ORDERS}}
            for w, c in words.items():
                for n in ORDERS:
                    for g in grams(w, n):
                        by_n[n][g] += c
            for n, part in by_n.items():
                keys = list(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array([n] * len(keys), pa.int32()),
                     pa.array(keys, pa.string()), pa.array([part[k] for k in keys], pa.int64())],
                    names=["lang", "n", "gram", "c"])

    counted = (sample.select("text", "lang").mapInArrow(count, "lang string, n int, gram string, c bigint")
               .groupBy("n", "gram", "lang").agg(F.sum("c").alias("c")))
    by_gram = (counted.groupBy("n", "gram").agg(F.collect_list(F.struct("lang", "c")).alias("by"),
                                                F.sum("c").alias("all"))
               .where(F.col("all") >= min_count))
    at = {x: k for k, x in enumerate(langs)}
    counts: dict[int, dict[str, dict[int, int]]] = {}
    found = by_gram.select("n", "gram", F.col("by.lang").alias("l"), F.col("by.c").alias("c")).toArrow()
    for n, gram, ls, cs in sorted(zip(*[found.column(k).to_pylist() for k in range(4)])):
        counts.setdefault(n, {})[gram] = {at[x]: c for x, c in zip(ls, cs)}
    return Model(langs, counts)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *more: Column
            ) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, and the ``more`` boolean columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            out = [scorer.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array([x for x, _ in out], pa.string()),
                 pa.array([x for _, x in out], pa.float64())],
                names=[*names, "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"), *more)
    names = ["doc_id", *rows.columns[2:]]
    schema = ", ".join(["doc_id bigint", *[f"{c} boolean" for c in names[1:]], "lang_pred string", "score double"])
    return rows.mapInArrow(run, schema)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned where the fold is not 2."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(fold("doc_id", 4) != 2))
    return predict(docs, model, "doc_id", "text", (fold("doc_id", 4) == 2).alias("held_out"))

"""Operator 2, quality rules: a ledger of rule failures as bits.

Every rule is evaluated once for each document. The ledger keeps the
measurements and one bit for each rule failed. A policy is a versioned mask of
rules: it keeps the documents that fail none of them, so policies are applied,
compared and taken apart on the ledger alone, without reading a text again.

Measuring needs all words of a text with their places, so it runs in Arrow
batches, a text at a time; memory is bounded by the longest text. What
follows on the ledger is bitwise DataFrame work.

Defined cases: NULL, empty and blank texts have no words, all measurements 0,
and fail ``few_words``; ratios over no words are 0; a NULL id stays NULL;
repeated rows and equal ids are measured each for itself; an empty table gives
an empty ledger; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored, table

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_upper", "n_letters", "n_marks", "n_top_word"]
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"


def repeat_words(ids: np.ndarray) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    if len(ids) < 4:
        return 0
    _, pair = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)
    window = pair[:-1] * (int(ids.max()) + 1) + ids[2:]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        covered[k:len(ids) - 2 + k] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    raw = (text or "").encode()
    words = raw.split()  # of bytes: cuts at the six ASCII white-space characters only
    if not words:
        return (0,) * len(MEASURES)
    kept = raw.translate(None, SPACE)
    octets = np.bincount(np.frombuffer(kept, np.uint8), minlength=256)
    chars = int(octets[:128].sum() + octets[192:].sum())
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip(SPACE)]
    upper = int(octets[65:91].sum())
    return (len(words), chars, int(octets[list(SYMBOLS)].sum()), len(lines) - len(set(lines)),
            repeat_words(ids), len(lines), upper,
            upper + int(octets[97:123].sum()), int(octets[33]), int(np.bincount(ids).max()))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements, a row for each input row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([measure(t.as_py()) for t in b.column(1)], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(rows[:, k]) for k in range(len(MEASURES))]],
                names=["doc_id", *MEASURES])

    schema = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, schema)


def _more(part: str, percent: int, whole: str) -> Column:
    return F.col(part) * 100 > F.col(whole) * percent


#: The rules, each a bit in this order; true where a document fails.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "n_words >= 50 and word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "upper_case": "n_letters > 0 and 100 * n_upper > 60 * n_letters",
    "exclamation_marks": "100 * n_marks > 30 * n_words",
    "one_word": "n_words >= 50 and 100 * n_top_word > 40 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules; a document that fails any of them goes."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: dict = RULES) -> int:
        order = list(rules)
        return sum(1 << order.index(r) for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
FULL = Policy("prose", 1, tuple(RULES))


def ledger(docs: DataFrame, rules: dict = RULES, id_col: str = "doc_id", text_col: str = "text"
           ) -> DataFrame:
    """``doc_id``, the measurements and ``fail_bits``: bit k is set where rule k fails."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules.values()):
        failed = F.expr(rule) if isinstance(rule, str) else rule
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured(docs, id_col, text_col).withColumn("fail_bits", bits)


def fails(policy: Policy, rules: dict = RULES) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) != 0


def ablations(book: DataFrame, policies: Iterable[Policy], rules: dict = RULES) -> DataFrame:
    """For each policy and rule: documents kept, and kept with that rule left out.

    The ledger is first counted by its bits (at most one row for each pattern
    of failures seen), and the masks are then tried on those counts.
    """
    patterns = book.groupBy("fail_bits").agg(F.count(F.lit(1)).alias("n"))
    order = list(rules)
    tries = [F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"),
                      F.lit(r).alias("rule"), F.lit(p.mask(rules)).cast("long").alias("mask"),
                      F.lit(p.mask(rules) & ~(1 << order.index(r))).cast("long").alias("without"))
             for p in policies for r in p.rules]
    tried = patterns.select("fail_bits", "n", F.explode(F.array(*tries)).alias("t")).select("*", "t.*")
    passed = lambda m: F.col("fail_bits").bitwiseAND(F.col(m)) == 0
    return tried.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("documents"),
        F.sum(F.when(passed("mask"), F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(passed("without"), F.col("n")).otherwise(0)).alias("kept_without"),
        F.bit_or("fail_bits").alias("bits_seen"))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    """The ledger of all ``documents``, stored, with the verdicts of both policies."""
    book = stored(ledger(table(spark, sf_dir, "documents")), "ledger")
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", fails(BASE).alias("base_failed"),
                       (~fails(BASE) & ~fails(FULL)).alias("kept"), "fail_bits")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k)
  WHERE n > 1 GROUP BY r),
words AS (SELECT r, max(n) AS top FROM (
  SELECT r, x, count(*) AS n FROM (SELECT r, unnest(w) AS x FROM d) GROUP BY r, x) GROUP BY r),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks, coalesce(top, 0) AS n_top
  FROM d LEFT JOIN covered USING (r) LEFT JOIN words USING (r) LEFT JOIN lines USING (r)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
    + 4 * (100 * n_symbols > 30 * n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
    + 16 * (n_words >= 50 AND word_chars < 2 * n_words)::BIGINT
    + 32 * (word_chars > 25 * n_words)::BIGINT
    + 64 * (n_letters > 0 AND 100 * n_upper > 60 * n_letters)::BIGINT
    + 128 * (100 * n_marks > 30 * n_words)::BIGINT
    + 256 * (n_words >= 50 AND 100 * n_top > 40 * n_words)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, fail_bits % 4 > 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits
FROM b
"""

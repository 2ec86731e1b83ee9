"""A training corpus from raw documents, in five stages.

Each stage is a function of (spark, docs, sf_dir) on what the stage before it
kept, and calls one of the operators of ``adlens.llm``:

1. quality classifier: documents outside the importance sample go;
2. exact dedup: of equal texts the row of the largest id stays;
3. near-dedup on five-word shingles: one document of each group stays, the one
   of the smallest id;
4. mixing: sources are taken to their target weights; a document is repeated,
   cut to the blocks taken of it, or goes, and ``n_chars`` follows the text;
5. SentencePiece: every document as piece ids, with a round-trip check.

``run`` applies them to the documents, each stage's result written as Parquet
in the shared scratch folder and read again. All stages but the last return
the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import at_rows, scanned, stored, table
from adlens.llm.exact_dedup import exact_dedup
from adlens.llm.importance import resample
from adlens.llm.mixing import mixed_documents
from adlens.llm.near_dedup import near_dedup
from adlens.llm.segmentation import encoded


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resample(docs, table(spark, sf_dir, "labels"), keep_columns=True)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = scanned(docs)
    return at_rows(docs, exact_dedup(docs).where("kept").select("_place"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = scanned(docs)
    return at_rows(docs, near_dedup(docs).where("stays").select("_place"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixed_documents(docs)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs).withColumn("n_pieces", F.size("pieces").cast("long"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("MinHash near-dedup", near_duplicates),
    ("mixing to target weights", mix),
    ("SentencePiece pieces", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs


ORACLE_SQL = None  # sampling noise, hashed blocks and the piece lattice are outside SQL

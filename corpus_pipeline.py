"""From documents to packed training sequences, one stage after another.

Every stage reads all rows the one before kept; each but the last returns the
columns of documents. Ids may be null or repeated; see the operators for what
that means to each.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscout.llm import chunk_dedup, mixing, packing, quality, simhash
from shelfscout.llm.common import keep_rows
from shelfscout.session import materialise

ID, TEXT = "doc_id", "text"
LEAST_SCORE = 0.3
SHINGLE, MOST_BITS = 3, 2
SHARE, WEIGHTS, MOST_COPIES = 1.5, (3, 1, 2), 2.0
TOKENIZER, LONGEST, END_ID = "byte_bpe_50k.json", 1024, 0


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier scores at ``LEAST_SCORE`` or more; learned as in its query."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(F.crc32(F.col(ID).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = quality.train(docs, labels, id_col=ID, text_col=TEXT, usable=~held_out)
    # The whole row in one column: no name of it can clash with the score's.
    row = F.struct(*[F.col(f"`{name}`").alias(name) for name in docs.columns]).alias("row")
    scored = quality.score(docs.select(row, F.col(TEXT).alias("text")), model, "text", "score")
    return scored.where(F.col("score") >= LEAST_SCORE).select("row.*")


def first_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_rows(docs, chunk_dedup.chunk_dedup(docs, ID, TEXT), ID, TEXT)


def first_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints."""
    return keep_rows(docs, simhash.near_duplicates(docs, ID, TEXT, SHINGLE, MOST_BITS), ID, TEXT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    found = mixing.mix(docs, ID, TEXT, share=SHARE, weights=WEIGHTS, most=MOST_COPIES)
    return mixing.copy_rows(docs, found, ID, TEXT)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces, their token ids included."""
    path = public_tokenizers.path(TOKENIZER)
    found = packing.decompose(docs, path, ID, TEXT, LONGEST, END_ID)
    return found.withColumnsRenamed({"id": "doc_id", "sequence": "sequence_id"})


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", first_of_equal),
    ("SimHash near-dedup", first_of_near),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

# Learned weights, fingerprints and token ids are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{number}")
    return docs

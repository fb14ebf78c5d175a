"""Training-corpus pipeline: quality, exact dedup, near dedup, mixing, packing.

Every stage reads the whole output of the one before, as Parquet in the shared
folder, and keeps the columns of `documents`; the last returns packed pieces.

Stages decide by row, not by doc_id, so ids may be null or repeated: the
classifier's verdict holds for rows equal in id, text, source and lang; of equal
texts one row stays (largest id), of each near-duplicate component one row
(smallest id, rows without id last); the mix gives each row its copies.  No text
is cut before packing.  Null, empty and wordless texts are equal to their like:
null and empty ones are one text, and one fingerprint holds all wordless ones; a
row without words has size 0, so the mix leaves it out.  Very long texts pass
whole.  An empty table gives no piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import exact_dedup, mixing, packing, quality_classifier, simhash
from ledgerline.llm.common import stage, table

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component the row with the smallest doc_id stays."""
    return simhash.drop_near_copies(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents repeated, sampled or left out, each whole."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.piece_digests(packing.pack(docs, public_tokenizers.path(TOKENIZER)))


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("mixing to target weights", mix), ("packing", pack)]

#: Hash sketches, a trained model and a tokenizer are beyond SQL; the tests hold
#: every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)

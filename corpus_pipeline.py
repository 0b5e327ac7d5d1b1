"""The corpus pipeline: a chain of the operators over `documents`.

Each stage reads what its predecessor kept. All but the last return the columns of `documents`; the last returns the
documents' token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.mixing import mix
from tidemark.llm.quality import KEEP_FROM, quality_scores
from tidemark.llm.queries import encoded_digests
from tidemark.llm.simhash import near_dedup
from tidemark.llm.text import Shelf


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels, outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return docs.filter(quality_scores(docs, labels, F.col("text")) >= KEEP_FROM)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest id."""
    return exact_dedup(docs, carry=True).filter("kept").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, the one with the smallest id."""
    return near_dedup(docs, carry=True).filter("kept").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, or up to three times."""
    return mix(docs, carry=True).filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digests of the ids and of what they decode to."""
    return encoded_digests(docs, keep_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("simhash near-dedup", without_near_copies),
    ("mixing sources", mixed),
    ("byte-level bpe", tokens),
]

#: SQL has no trained classifier and no byte-pair merges; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written and read again."""
    docs, shelf = spark.read.parquet(f"{sf_dir}/documents.parquet"), Shelf(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = shelf.put(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs

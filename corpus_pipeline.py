"""A corpus from raw documents to training sequences: five stages, each of one operator.

``run`` applies them in order; each result is written as Parquet to the shared folder
and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import mixing, packing, quality_model, secrets, simhash
from waybill.llm.queries import table, target_weights, tokenizer_path, with_domain
from waybill.session import materialised

#: SQL can't express the first stage (a fitted model over numpy features).
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return quality_model.accepted(docs, quality_model.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by marks, n_chars brought up to date."""
    return secrets.masked(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the epochs of their leaf take them."""
    leaves = docs.select("doc_id", "text", "lang", "source")
    leaves = with_domain(leaves)
    return mixing.taken(docs, mixing.mixed(leaves, target_weights(leaves)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", near_dedup),
    ("secret scans", mask_secrets),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir))
    return docs

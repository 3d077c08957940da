"""From raw documents to training sequences: toxicity, exact copies, near copies, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bloom_dedup, packing, pii, queries, simhash, toxicity
from tallyloom.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half; the model learns from the labelled ones among ``docs``."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id."""
    return bloom_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, the one with the smallest id."""
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; lang and source stay behind with the documents."""
    return packing.pack(docs, queries.byte_bpe())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", redact),
    ("packing", pack),
]

# The learned stages, the fingerprints and the tokens have no SQL form; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs

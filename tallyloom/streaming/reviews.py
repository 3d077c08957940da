"""Review stream: rule labels, routes and token estimates per micro-batch, for reviews not worked on before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from ..operators import budget, reviews as rv
from .orders import UP_TO_NOW, _put, run_batches

REMEMBERED = "30 days"  # so long a review and its text are known after they came


def work_for_models(texts: DataFrame) -> DataFrame:
    """What a texts table needs from the models: key, text, route and estimated tokens."""
    return texts.select(
        "dedup_key",
        "review_id",
        "raw_text",
        "route",
        "issues",
        "needs_manual_review",
        budget.estimate_tokens(F.col("raw_text")).alias("tokens"),
    )


def speaking_reviews(reviews: DataFrame) -> DataFrame:
    return rv.review_records(reviews).where(F.col("raw_text") != "")


def unknown_reviews(reviews: DataFrame, model_version: str) -> DataFrame:
    """Reviews with a text and a low score that this model version has not seen with this text for REMEMBERED.

    What is known is the engine's keyed state, spread over its partitions by the key, so a micro-batch looks up
    its own keys only; a key leaves the state REMEMBERED after it came.
    """
    keyed = speaking_reviews(reviews).withColumns({"model_version": F.lit(model_version), "arrived": F.current_timestamp()})
    return keyed.withWatermark("arrived", REMEMBERED).dropDuplicatesWithinWatermark(["review_id", "text_hash", "model_version"])


def review_job(
    reviews: DataFrame, folder: str, checkpoint: str, model_version: str, trigger: dict = UP_TO_NOW
) -> StreamingQuery:
    """Routed texts of every micro-batch that hold new work, in ``folder/texts``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        _put(work_for_models(rv.route_texts(rv.dedup_texts(batch))), f"{folder}/texts", batch_id)

    return run_batches(unknown_reviews(reviews, model_version), checkpoint, sink, trigger)


def current_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The texts of all micro-batches, each once; its lowest review id speaks for it."""
    rows = spark.read.parquet(f"{folder}/texts").drop("batch_id")
    return rows.groupBy("dedup_key").agg(F.min_by(F.struct(*rows.columns), "review_id").alias("t")).select("t.*")

"""Samples for human labels and the figures drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import n_rows, pct

METHODS = ["rule", "small_llm", "large_llm"]


def accuracy_sample(expanded: DataFrame, per_method: int = 30, batch_size: int = 10) -> DataFrame:
    """The first reviews of each method by a stable hash, cut into batches."""
    order = F.sha1(F.concat("review_id", "raw_text"))
    rank = F.row_number().over(Window.partitionBy("method").orderBy("h", "review_id"))
    return (
        expanded.where(F.col("method").isin(METHODS) & (F.col("raw_text") != ""))
        .select("review_id", "method", order.alias("h"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= per_method)
        .select(
            "review_id",
            "method",
            "rank",
            (F.floor((F.col("rank") - 1) / batch_size) + 1).cast("int").alias("batch"),
        )
    )


def accuracy_metrics(judged: DataFrame) -> DataFrame:
    """Rates over all judged reviews, per batch and per method.

    ``judged`` holds per review: ``batch, method, class_ok, issues, issues_supported, issues_invented,
    true_issues, missed_issues, actionable_ok``.
    """

    def rate(part: str, whole: Column) -> Column:
        return pct(F.sum(part), whole, 1)

    return judged.groupingSets([[], ["batch"], ["method"]], "batch", "method").agg(
        n_rows().alias("reviews"),
        rate("class_ok", n_rows()).alias("classification_accuracy_pct"),
        rate("issues_supported", F.sum("issues")).alias("evidence_compliance_pct"),
        rate("missed_issues", F.sum("true_issues")).alias("missed_recall_pct"),
        rate("issues_invented", F.sum("issues")).alias("hallucination_pct"),
        rate("actionable_ok", n_rows()).alias("actionable_accuracy_pct"),
    )

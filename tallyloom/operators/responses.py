"""Model answers: validation, escalation, merging and the way back to reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv
from ..functions.numeric import n_rows
from ..functions.text import quotes_found
from .reviews import excerpt, issue, worth_retry

ACCEPTED, SCHEMA_ERROR, EVIDENCE_ERROR, LOW_CONFIDENCE, MISSING = (
    "accepted",
    "schema_error",
    "evidence_error",
    "low_confidence",
    "missing",
)
ANSWER = (
    "struct<issues:array<struct<category:string,subcategory:string,evidence:string,confidence:string>>,"
    "needs_manual_review:string,_broken:string>"
)


def _in_taxonomy(i: Column) -> Column:
    kinds = [f"{c}.{s}" for c, subs in fv.TAXONOMY.items() for s in subs]
    return F.concat_ws(".", i["category"], i["subcategory"]).isin(kinds)


def validate_responses(responses: DataFrame, texts: DataFrame) -> DataFrame:
    """Parsed answers with a status.

    ``responses`` holds ``dedup_key, tier, raw_json``; ``texts`` holds ``dedup_key, raw_text``. A
    small-model answer is judged on confidence before its evidence, a large-model answer the other
    way round.
    """
    parsed = (
        responses.join(texts.select("dedup_key", "raw_text"), "dedup_key")
        .withColumn(
            "a", F.from_json("raw_json", ANSWER, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
        )
        .withColumn(
            "issues",
            F.transform(
                "a.issues",
                lambda i: F.struct(
                    i["category"].alias("category"),
                    i["subcategory"].alias("subcategory"),
                    i["evidence"].alias("evidence"),
                    i["confidence"].try_cast("double").alias("confidence"),
                ),
            ),
        )
    )
    sound = F.forall(
        "issues",
        lambda i: F.coalesce(
            _in_taxonomy(i) & i["evidence"].isNotNull() & i["confidence"].between(0.0, 1.0), F.lit(False)
        ),
    )
    well_formed = F.col("a._broken").isNull() & (F.size("issues") > 0) & sound
    checked = parsed.withColumns(
        {
            "well_formed": F.coalesce(well_formed, F.lit(False)),
            "found": quotes_found(
                F.col("raw_text"), F.coalesce(F.transform("issues", lambda i: i["evidence"]), F.array())
            ),
        }
    )
    # An issue that fails the form check may have no evidence; it counts as not found.
    supported = F.forall("found", lambda f: F.coalesce(f, F.lit(False)))
    unsure = F.array_min(F.transform("issues", lambda i: i["confidence"])) < fv.MIN_CONFIDENCE
    is_small = F.col("tier") == "small"
    status = (
        F.when(F.col("raw_json").isNull(), MISSING)
        .when(~F.col("well_formed"), SCHEMA_ERROR)
        .when(is_small & unsure, LOW_CONFIDENCE)
        .when(~supported, EVIDENCE_ERROR)
        .when(unsure, LOW_CONFIDENCE)
        .otherwise(ACCEPTED)
    )
    flagged = F.coalesce(~F.col("a.needs_manual_review").isin("false", "0", "null", ""), F.lit(False))
    return checked.select(
        "dedup_key",
        "tier",
        status.alias("status"),
        F.when(F.col("well_formed"), F.col("issues")).cast(schemas.ISSUES).alias("issues"),
        flagged.alias("needs_manual_review"),
    )


def small_outcomes(routed: DataFrame, batches: DataFrame, plan: DataFrame, judged: DataFrame) -> DataFrame:
    """What became of each text of the small route: done, fallback or retry."""
    decided = (
        batches.select("dedup_key", "batch_id")
        .join(plan.where(F.col("phase") == 1).select("batch_id", "accepted"), "batch_id")
        .select("dedup_key", "accepted")
    )
    answers = judged.where(F.col("tier") == "small").select(
        "dedup_key", "status", F.col("issues").alias("found"), F.col("needs_manual_review").alias("flag")
    )
    texts = routed.where(F.col("route") == fv.ROUTE_SMALL).select("dedup_key", "raw_text", "normalized_text")
    outcome = (
        F.when(~F.col("accepted"), "fallback")
        .when(F.col("status") == ACCEPTED, "done")
        .when(worth_retry(F.col("normalized_text")), "retry")
        .otherwise("fallback")
    )
    return (
        texts.join(decided, "dedup_key").join(answers, "dedup_key", "left").withColumn("outcome", outcome)
    )


def escalation(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome", F.coalesce("status", F.lit(MISSING)).alias("status")).agg(
        n_rows().alias("texts")
    )


def _result(method: Column | str, model: Column, issues: Column, review: Column) -> list[Column]:
    return [
        F.col("dedup_key"),
        issues.cast(schemas.ISSUES).alias("issues"),
        (F.lit(method) if isinstance(method, str) else method).alias("method"),
        model.cast("string").alias("model"),
        review.alias("needs_manual_review"),
    ]


def _fallback(route: str) -> list[Column]:
    vague = F.array(issue("general", "unclear", excerpt(F.col("raw_text")), fv.FALLBACK_CONFIDENCE))
    return _result(f"offline_{route}_fallback", F.lit(None), vague, F.lit(True))


def offline_results(routed: DataFrame) -> DataFrame:
    """Results without any model: rules, and the fallback for everything else."""
    ruled = routed.where(F.col("route") == fv.ROUTE_RULE).select(
        _result(fv.ROUTE_RULE, F.lit(None), F.col("issues"), F.col("needs_manual_review"))
    )
    for route in (fv.ROUTE_SMALL, fv.ROUTE_LARGE):
        ruled = ruled.unionByName(routed.where(F.col("route") == route).select(_fallback(route)))
    return ruled


def merged_results(
    routed: DataFrame,
    outcomes: DataFrame,
    plan: DataFrame,
    retry_plan: DataFrame,
    judged: DataFrame,
    small_model: str,
    large_model: str,
) -> DataFrame:
    """One result per distinct text: rule, accepted answer, escalated answer or fallback.

    A large-model answer of low confidence stays, marked for a person.
    """
    ruled = routed.where(F.col("route") == fv.ROUTE_RULE).select(
        _result(fv.ROUTE_RULE, F.lit(None), F.col("issues"), F.col("needs_manual_review"))
    )
    small_done = outcomes.where(F.col("outcome") == "done").select(
        _result(fv.ROUTE_SMALL, F.lit(small_model), F.col("found"), F.col("flag"))
    )
    small_failed = outcomes.where(F.col("outcome") == "fallback").select(_fallback(fv.ROUTE_SMALL))

    gate = plan.where(F.col("phase") == 2).unionByName(retry_plan)
    asked = (
        routed.where(F.col("route") == fv.ROUTE_LARGE)
        .select("dedup_key", "raw_text")
        .unionByName(outcomes.where(F.col("outcome") == "retry").select("dedup_key", "raw_text"))
        .join(gate.select(F.col("call_key").alias("dedup_key"), "accepted"), "dedup_key")
    )
    answers = judged.where(F.col("tier") == "large").select(
        "dedup_key", "status", F.col("issues").alias("found"), F.col("needs_manual_review").alias("flag")
    )
    judged_large = asked.join(answers, "dedup_key", "left").withColumn(
        "kept",
        F.col("accepted") & F.coalesce(F.col("status").isin(ACCEPTED, LOW_CONFIDENCE), F.lit(False)),
    )
    large_done = judged_large.where("kept").select(
        _result(
            fv.ROUTE_LARGE,
            F.lit(large_model),
            F.col("found"),
            F.col("flag") | (F.col("status") == LOW_CONFIDENCE),
        )
    )
    large_failed = judged_large.where("not kept").select(_fallback(fv.ROUTE_LARGE))
    return (
        ruled.unionByName(small_done)
        .unionByName(small_failed)
        .unionByName(large_done)
        .unionByName(large_failed)
    )


def expand_reviews(records: DataFrame, results: DataFrame) -> DataFrame:
    """Results on every review of a text; evidence that a review does not hold is replaced by its
    own excerpt. ``results`` is a written table with one row per text, so adaptive execution splits a
    text with very many reviews."""
    joined = records.drop("normalized_text").join(results.withColumnRenamed("dedup_key", "text_hash"), "text_hash")
    found = quotes_found(F.col("raw_text"), F.transform("issues", lambda i: i["evidence"]))
    own = excerpt(F.col("raw_text"))
    adapted = F.zip_with(
        "issues",
        "found",
        lambda i, ok: F.struct(
            i["category"].alias("category"),
            i["subcategory"].alias("subcategory"),
            F.when(ok, i["evidence"]).otherwise(F.col("own")).alias("evidence"),
            i["confidence"].alias("confidence"),
        ),
    )
    actionable = ~F.col("needs_manual_review") & F.exists("issues", lambda i: i["category"] != "general")
    return (
        joined.withColumns({"found": found, "own": own})
        .withColumn("issues", adapted.cast(schemas.ISSUES))
        .select(
            "review_id",
            "order_id",
            "review_score",
            "raw_text",
            F.col("text_hash").alias("normalized_text_hash"),
            "issues",
            "method",
            "model",
            "needs_manual_review",
            actionable.alias("actionable_for_seller"),
        )
    )


def _weighed(texts: DataFrame, results: DataFrame) -> DataFrame:
    """Results with the number of reviews that share the text; reviews need not be expanded to be counted."""
    return results.join(texts.select("dedup_key", "n_reviews"), "dedup_key")


def issue_counts(texts: DataFrame, results: DataFrame) -> DataFrame:
    """Issues per category over all reviews; adapting evidence to a review changes no category."""
    return (
        _weighed(texts, results)
        .select("n_reviews", F.explode("issues").alias("i"))
        .groupBy("i.category", "i.subcategory")
        .agg(F.sum("n_reviews").alias("issues"))
    )


def method_counts(texts: DataFrame, results: DataFrame) -> DataFrame:
    return _weighed(texts, results).groupBy("method").agg(F.sum("n_reviews").alias("records"))

"""Review issue extraction around an external model call.

Everything up to the call is planned here, and the answers come back as a table. Tables that several
later steps read are written once to the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.numeric import count_where, n_rows
from ..operators import budget, responses as rs, reviews as rv
from ..session import stored
from ..sources.files import write_review_results


@dataclass(frozen=True)
class Routed:
    """Low-score reviews and their distinct, routed texts."""

    records: DataFrame
    texts: DataFrame


@dataclass(frozen=True)
class Extraction:
    """Tables of a run with model answers."""

    batches: DataFrame
    plan: DataFrame
    judged: DataFrame
    outcomes: DataFrame
    retry_plan: DataFrame
    results: DataFrame


def route_reviews(reviews: DataFrame) -> Routed:
    records = stored(rv.review_records(reviews), "records")
    return Routed(records, stored(rv.route_texts(rv.dedup_texts(records)), "texts"))


def with_answers(
    texts: DataFrame,
    answers: DataFrame,
    cap_usd: float | None = fv.DEFAULT_COST_CAP_USD,
    token_budget: int = fv.BATCH_TOKEN_BUDGET,
    small_model: str = "small",
    large_model: str = "large",
) -> Extraction:
    batches = stored(budget.pack_batches(budget.small_items(texts), token_budget), "batches")
    large = texts.where(F.col("route") == fv.ROUTE_LARGE)
    first_calls = budget.batch_calls(batches).unionByName(budget.single_calls(large, 2))
    plan = stored(budget.budget_gate(first_calls, cap_usd), "plan")
    judged = stored(rs.validate_responses(answers, texts), "judged")
    outcomes = stored(rs.small_outcomes(texts, batches, plan, judged), "outcomes")
    retries = budget.single_calls(outcomes.where(F.col("outcome") == "retry"), 3)
    spent = plan.agg(F.coalesce(F.sum("cost"), F.lit(0)).alias("s")).scalar()
    retry_plan = stored(budget.budget_gate(retries, cap_usd, spent), "retries")
    results = stored(
        rs.merged_results(texts, outcomes, plan, retry_plan, judged, small_model, large_model), "results"
    )
    return Extraction(batches, plan, judged, outcomes, retry_plan, results)


def made_answers(run: Extraction) -> DataFrame:
    """Judged answers to calls that were made: key and tier of an accepted call."""
    small = run.outcomes.where("accepted").select("dedup_key", F.lit("small").alias("tier"))
    calls = run.plan.where(F.col("phase") == 2).unionByName(run.retry_plan).where("accepted")
    large = calls.select(F.col("call_key").alias("dedup_key"), F.lit("large").alias("tier"))
    return run.judged.join(small.unionByName(large), ["dedup_key", "tier"], "left_semi")


def metadata(routed: Routed, run: Extraction | None, results: DataFrame) -> DataFrame:
    """One row that describes a run; without answers nothing is called and nothing is spent."""
    records = routed.records.agg(
        n_rows().alias("record_count"),
        count_where(F.col("raw_text") == "").alias("empty_text_count"),
    )
    routes = routed.texts.agg(
        n_rows().alias("dedup_count"),
        *[count_where(F.col("route") == r).alias(f"{r}_texts") for r in (fv.ROUTE_RULE, fv.ROUTE_SMALL, fv.ROUTE_LARGE)],
    )
    counts = rs.method_counts(routed.texts, results)
    methods = counts.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("method") == m, F.col("records"))), F.lit(0)).alias(f"{m}_records")
            for m in (
                fv.ROUTE_RULE,
                fv.ROUTE_SMALL,
                fv.ROUTE_LARGE,
                f"offline_{fv.ROUTE_SMALL}_fallback",
                f"offline_{fv.ROUTE_LARGE}_fallback",
            )
        ],
    )
    columns = [df.select(c).scalar().alias(c) for df in (routes, methods) for c in df.columns]
    if run is None:
        spent = {
            c: F.lit(v)
            for c, v in {
                "estimated_cost_usd": 0.0,
                "estimated_input_tokens": 0,
                "estimated_output_tokens": 0,
                "llm_call_count": 0,
                "schema_error_count": 0,
                "evidence_error_count": 0,
                "budget_exhausted": False,
            }.items()
        }
    else:
        calls = run.plan.unionByName(run.retry_plan)
        made = F.col("accepted")
        totals = calls.agg(
            budget.in_usd(F.coalesce(F.sum(F.when(made, F.col("cost"))), F.lit(0))).alias("estimated_cost_usd"),
            F.coalesce(F.sum(F.when(made, F.col("input_tokens"))), F.lit(0)).alias("estimated_input_tokens"),
            F.coalesce(F.sum(F.when(made, F.col("output_tokens"))), F.lit(0)).alias("estimated_output_tokens"),
            count_where(made).alias("llm_call_count"),
            F.coalesce(F.bool_or(~made), F.lit(False)).alias("budget_exhausted"),
        )
        errors = made_answers(run).agg(
            count_where(F.col("status") == rs.SCHEMA_ERROR).alias("schema_error_count"),
            count_where(F.col("status") == rs.EVIDENCE_ERROR).alias("evidence_error_count"),
        )
        spent = {c: df.select(c).scalar() for df in (totals, errors) for c in df.columns}
    return records.select("*", *columns, *[v.alias(c) for c, v in spent.items()])


def run_offline(reviews: DataFrame, path: str) -> None:
    """Rules and fallbacks only; results for every low-score review, as JSON lines."""
    routed = route_reviews(reviews)
    results = stored(rs.offline_results(routed.texts), "results")
    write_review_results(rs.expand_reviews(routed.records, results), metadata(routed, None, results), path)


def run_with_answers(
    reviews: DataFrame,
    answers: DataFrame,
    path: str,
    representatives_only: bool = True,
    **options,
) -> None:
    """Results with model answers, for the speaking review of each text or for every review."""
    routed = route_reviews(reviews)
    run = with_answers(routed.texts, answers, **options)
    records, texts = routed.records, routed.texts
    if representatives_only:
        records = records.join(texts.select("review_id"), "review_id", "left_semi")
        texts = texts.withColumn("n_reviews", F.lit(1).cast("bigint"))
    written = Routed(routed.records, texts)
    write_review_results(rs.expand_reviews(records, run.results), metadata(written, run, run.results), path)

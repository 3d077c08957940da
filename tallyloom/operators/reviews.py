"""Low-score reviews: text, duplicates, rule labels and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv
from ..functions.numeric import count_where, n_rows
from ..functions.text import few_words, matches, normalize_text, strip_space, text_hash, trimmed

REQUIRED = ["review_id", "order_id", "review_score", "review_comment_title", "review_comment_message"]


def low_score_reviews(reviews: DataFrame) -> DataFrame:
    missing = sorted(set(REQUIRED) - set(reviews.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return reviews.where(F.col("review_score") <= fv.LOW_SCORE_MAX).select(*REQUIRED)


def raw_text(title: Column, message: Column) -> Column:
    """Title and message without outer white space, one blank between; blank parts are left out."""
    return F.concat_ws(" ", *[F.nullif(trimmed(part), F.lit("")) for part in (title, message)])


def review_records(reviews: DataFrame) -> DataFrame:
    """Low-score reviews with raw text, normalised text and its hash."""
    low = low_score_reviews(reviews)
    raw = raw_text(F.col("review_comment_title"), F.col("review_comment_message"))
    return (
        low.select("review_id", "order_id", "review_score", raw.alias("raw_text"))
        .withColumn("normalized_text", normalize_text(F.col("raw_text")))
        .withColumn("text_hash", text_hash(F.col("normalized_text")))
    )


def dedup_texts(records: DataFrame) -> DataFrame:
    """One row per distinct normalised text; the lowest review id speaks for its group.

    A hash has one normalised text, so both make the group, and raw texts move only if they are asked for.
    """
    first = F.min(F.struct("review_id", "raw_text"))
    return (
        records.groupBy(F.col("text_hash").alias("dedup_key"), "normalized_text")
        .agg(first.alias("first"), n_rows().alias("n_reviews"))
        .select("dedup_key", "first.*", "normalized_text", "n_reviews")
    )


def duplicate_text_stats(records: DataFrame) -> DataFrame:
    """Reviews with and without text, and how many texts repeat."""
    texts = records.groupBy("raw_text").agg(n_rows().alias("n"))
    filled = F.col("raw_text") != ""
    return texts.agg(
        F.sum("n").alias("reviews"),
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("with_text"),
        F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("without_text"),
        count_where(filled).alias("unique_texts"),
        count_where(filled & (F.col("n") > 1)).alias("repeated_texts"),
    )


def duplicate_text_top(records: DataFrame, limit: int = 30) -> DataFrame:
    """The most frequent texts."""
    texts = records.where(F.col("raw_text") != "").groupBy("raw_text").agg(n_rows().alias("reviews"))
    return texts.orderBy(F.desc("reviews"), "raw_text").limit(limit)


def excerpt(raw: Column) -> Column:
    return F.substring(trimmed(raw), 1, fv.EXCERPT_CHARS)


def issue(category: str, subcategory: str, evidence: Column, confidence: float) -> Column:
    return F.struct(
        F.lit(category).alias("category"),
        F.lit(subcategory).alias("subcategory"),
        evidence.alias("evidence"),
        F.lit(float(confidence)).alias("confidence"),
    )


def rule_issues(raw: Column, normalized: Column) -> tuple[Column, Column]:
    """Issues that rules find, null if none does, and whether a person should look.

    Empty texts come first, then texts that contradict the score, then texts with little in them,
    then the issue patterns; each kind of issue counts once, with its first pattern.
    """
    said = excerpt(raw)
    by_kind: dict[tuple[str, str], list[Column]] = {}
    for (pattern, category, subcategory, confidence), stems in zip(fv.ISSUE_PATTERNS, fv.ISSUE_STEMS, strict=True):
        found = F.when(matches(normalized, pattern, stems), issue(category, subcategory, said, confidence))
        by_kind.setdefault((category, subcategory), []).append(found)
    found = F.array_compact(F.array(*[F.coalesce(*options) for options in by_kind.values()]))
    empty = normalized == ""
    positive = matches(normalized, fv.POSITIVE_PATTERN, longest=fv.WHOLE_TEXT_MAX_CHARS)
    vague = few_words(normalized, fv.LOW_DETAIL_MAX_WORDS) | matches(
        normalized, fv.LOW_INFORMATION_PATTERN, longest=fv.WHOLE_TEXT_MAX_CHARS
    )
    issues = (
        F.when(empty, F.array(issue("general", "negative_low_detail", F.lit(""), fv.EMPTY_CONFIDENCE)))
        .when(positive, F.array(issue("general", "unclear", said, fv.POSITIVE_CONFIDENCE)))
        .when(vague, F.array(issue("general", "negative_low_detail", said, fv.LOW_DETAIL_CONFIDENCE)))
        .when(F.size(found) > 0, found)
    )
    return issues.cast(schemas.ISSUES), empty | positive


def complex_markers(normalized: Column) -> Column:
    return F.regexp_count(normalized, F.lit("(?U)" + fv.COMPLEX_MARKER_PATTERN))


def route_texts(texts: DataFrame) -> DataFrame:
    """Rule labels, route and reason per distinct text."""
    issues, review = rule_issues(F.col("raw_text"), F.col("normalized_text"))
    length = F.length("normalized_text")
    is_long = length > fv.LARGE_MIN_CHARS
    is_mixed = (length > fv.SMALL_MAX_CHARS) & (
        complex_markers(F.col("normalized_text")) >= fv.COMPLEX_MARKER_MIN
    )
    by_rule = F.col("issues").isNotNull()
    return texts.withColumns({"issues": issues, "needs_manual_review": review}).withColumns(
        {
            "route": F.when(by_rule, fv.ROUTE_RULE)
            .when(is_long | is_mixed, fv.ROUTE_LARGE)
            .otherwise(fv.ROUTE_SMALL),
            "reason": F.when(by_rule, "rule or low-information template")
            .when(is_long, F.concat(F.lit("length "), length, F.lit(f" above {fv.LARGE_MIN_CHARS}")))
            .when(is_mixed, "medium length with several issue signals")
            .otherwise("short and not covered by rules"),
        }
    )


def route_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("route").agg(n_rows().alias("texts"), F.sum("n_reviews").alias("reviews"))


def worth_retry(normalized: Column) -> Column:
    """Whether a text that the small model failed on deserves the large one."""
    return (
        (F.length(normalized) >= fv.RETRY_MIN_CHARS)
        | (complex_markers(normalized) >= fv.COMPLEX_MARKER_MIN)
        | matches(normalized, fv.HIGH_VALUE_PATTERN)
    )


def exploded_issues(df: DataFrame, *keep: str) -> DataFrame:
    """One row per issue."""
    return df.select(*keep, F.posexplode("issues").alias("issue_no", "issue")).select(
        *keep, "issue_no", "issue.*"
    )


def cache_misses(records: DataFrame, cache: DataFrame, model_version: str) -> DataFrame:
    """Reviews whose text this model version has not processed for this review yet."""
    known = cache.where(F.col("model_version") == model_version).select("review_id", "text_hash")
    return records.join(known, ["review_id", "text_hash"], "left_anti")

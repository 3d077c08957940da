"""Registered queries: each operator over the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed_values as fv, sketches
from .operators import (
    association,
    budget,
    etl,
    evaluation,
    marketplace as mk,
    near_texts,
    profile,
    responses as rs,
    retail,
    reviews as rv,
)
from .plans import retail_etl, review_extraction as extraction
from .session import fresh_folder, is_staged, staged, stored
from .sources import bindings, files
from .streaming import orders as so, reconciliation, reviews as sr

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAIR_MIN_ITEM, PAIR_MIN_PAIR, PAIR_LARGE = 20, 3, 40
SELLER_YEAR = 1997
FANOUT_SINCE = datetime(1997, 1, 1)
CITY = "São"
ARRIVALS = 4
FILES_PER_BATCH = 32


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# --- retail lines ----------------------------------------------------------------------------


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's tables as retail lines, staged once for all queries."""
    return staged(spark, "retail-lines", sf_dir, lambda: bindings.retail_lines(spark, sf_dir))


def work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified lines, staged once: nearly all retail queries begin here."""
    return staged(spark, "work", sf_dir, lambda: retail.retail_work(lines(spark, sf_dir)))


def fresh_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classified lines unwritten, for queries that keep few of them: their filter comes before the joins and patterns."""
    return retail.retail_work(bindings.retail_lines(spark, sf_dir))


def on_work(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(work(spark, sf_dir))


QUERIES["retail_work"] = lambda spark, sf_dir: retail.retail_work(lines(spark, sf_dir))
on_work("quantity_extremes", profile.quantity_extremes)
on_work("extreme_gap_minutes", lambda w: profile.extreme_gap_minutes(profile.quantity_extremes(w)))
QUERIES["negative_price_rows"] = lambda spark, sf_dir: profile.negative_price_rows(fresh_work(spark, sf_dir))
on_work("bad_debt_rows", profile.bad_debt_rows)
on_work("price_issue_counts", profile.price_issue_counts)
on_work("missing_description_audit", profile.missing_description_audit)
on_work("high_price_items", profile.high_price_items)
on_work(
    "numeric_profile",
    lambda w: profile.numeric_profile(w, ["quantity", "price"]),
)
on_work(
    "line_amount_profile",
    lambda w: profile.numeric_profile(
        profile.positive_anonymous(w), ["line_amount"], [0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]
    ),
)
on_work("invoice_prefix_summary", profile.invoice_prefix_summary)
on_work("stock_category_summary", profile.stock_category_summary)
on_work("non_product_codes", profile.non_product_codes)
on_work("customer_missing_summary", profile.customer_missing_summary)
on_work("customer_missing_buckets", profile.customer_missing_buckets)
on_work("invoice_completeness", profile.invoice_completeness)
on_work("sales_measures", profile.sales_measures)
on_work("basket_sizes", profile.basket_sizes)
on_work("item_description", profile.item_description)
on_work("all_missing_description_codes", profile.all_missing_description_codes)
on_work("damage_descriptions", profile.damage_descriptions)
on_work("top_anonymous_items", profile.top_anonymous_items)
on_work("top_positive_anonymous_items", profile.top_positive_anonymous_items)
on_work("description_conflicts", profile.description_conflicts)
on_work("code_descriptions", lambda w: profile.code_descriptions(w, "20022"))
on_work("anonymous_by_country", profile.anonymous_by_country)
on_work("anonymous_invoice_patterns", profile.anonymous_invoice_patterns)
on_work("mixed_invoices", profile.mixed_invoices)
on_work("dot_share_of_missing_invoices", profile.dot_share_of_missing_invoices)
on_work("missing_customer_overlap", profile.missing_customer_overlap)
on_work("rows_per_invoice_hist", profile.rows_per_invoice_hist)
on_work("rows_per_invoice_profile", profile.rows_per_invoice_profile)
on_work("anonymous_by_month", profile.anonymous_by_month)
on_work("month_totals", lambda w: profile.month_totals(w, last=6))
on_work("amount_buckets", profile.amount_buckets)
on_work("date_range", profile.date_range)
on_work("flag_rules", association.flag_rules)
on_work("invoice_pattern_rules", association.invoice_pattern_rules)


def pair_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pair rules, staged once for the three queries on them."""

    def build() -> DataFrame:
        return association.item_pair_rules(work(spark, sf_dir), PAIR_MIN_ITEM, PAIR_MIN_PAIR, PAIR_LARGE)

    return staged(spark, "pair-rules", sf_dir, build)


QUERIES["item_pair_rules"] = pair_rules
QUERIES["item_pairs_top_support"] = lambda spark, sf_dir: association.top_pairs_by_support(pair_rules(spark, sf_dir))
QUERIES["item_pairs_balanced"] = lambda spark, sf_dir: association.top_balanced_pairs(pair_rules(spark, sf_dir), 5, 0.5)


@query("retail_source")
def retail_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract with the older column names and one column too many, conformed."""
    raw = lines(spark, sf_dir).withColumnsRenamed(
        {"Invoice": "InvoiceNo", "Price": "UnitPrice", "Customer ID": "CustomerID"}
    )
    return files.conform_retail(raw.withColumn("Extra", F.lit(1)))


@query("stock_code_class")
def stock_code_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work(spark, sf_dir).groupBy("stock_code", "stock_category").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("customer_id_norm")
def customer_id_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = work(spark, sf_dir).select(
        "customer_id_raw", retail.normalize_customer_id(F.col("customer_id_raw")).alias("customer_id")
    )
    return ids.groupBy("customer_id_raw", "customer_id").agg(F.count(F.lit(1)).alias("rows"))


SKETCHED, SKETCHED_AT = ["quantity", "price"], [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


@query("sketched_profile")
def sketched_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles out of written sketches, and whether each one's true rank is as near as is stated.

    The driver's days hold few lines each, so all days of a month share the sketch of its first day.
    """
    w, folder = work(spark, sf_dir), fresh_folder(spark, "day-sketches")
    months = w.withColumn("month", F.trunc("invoice_datetime", "month"))
    sketches.write_day_sketches(sketches.day_sketches(months, "month", SKETCHED), folder)
    found = sketches.sketched_quantiles(sketches.read_day_sketches(spark, folder), SKETCHED_AT)
    ranks = sketches.true_ranks(w, stored(found, "sketched"), SKETCHED)
    error = 2 * sketches.rank_error()  # beyond what is stated for 99 of 100 cases
    near = F.col("p").between(F.col("below") - error, F.col("upto") + error)
    return ranks.select("measure", "p", "n", near.alias("within_error"))


@query("null_report")
def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_report(lines(spark, sf_dir))


@query("output_null_report")
def output_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values per column of the three ETL outputs."""
    w = work(spark, sf_dir)
    facts = etl.sales_facts(w)
    outputs = {
        "sales_facts": facts,
        "customer_features": etl.customer_features(facts, w),
        "returns_log": etl.returns_log(w, facts),
    }
    reports = [
        profile.null_report(df).select(F.lit(name).alias("table"), "column", "missing_rows", "missing_pct")
        for name, df in outputs.items()
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query("string_profile")
def string_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir)
    return profile.string_profile(rows, ["Invoice", "StockCode", "Description", "Customer ID", "Country"])


@query("duplicate_check")
def duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir)
    return profile.duplicate_check(rows, work(spark, sf_dir))


@query("duplicate_rows")
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_rows(lines(spark, sf_dir))


# --- retail ETL ------------------------------------------------------------------------------

on_work("sales_facts", etl.sales_facts)


@query("customer_features")
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = work(spark, sf_dir)
    return etl.customer_features(etl.sales_facts(w), w)


on_work("primary_country", lambda w: etl.primary_country(etl.sales_facts(w)))
# A filter on the invoice reaches the scan of the lines, so only cancellations are classified, and nothing of them is written.
QUERIES["eligible_returns"] = lambda spark, sf_dir: etl.cancellations(retail.retail_work(lines(spark, sf_dir))).where(etl.eligible_return())
on_work(
    "return_match",
    lambda w: etl.match_returns(etl.cancellations(w).where(etl.eligible_return()), etl.sales_facts(w)),
)
on_work("returns_log", lambda w: etl.returns_log(w, etl.sales_facts(w)))
on_work("return_status", lambda w: etl.return_status(etl.returns_log(w, etl.sales_facts(w))))
on_work("unmatched_samples", lambda w: etl.unmatched_samples(etl.returns_log(w, etl.sales_facts(w))))


@query("sales_metric_table")
def sales_metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales measures beside the totals of the facts; the first and the fourth agree."""
    w = work(spark, sf_dir)
    return profile.sales_measures(w).unionByName(etl.fact_totals(w.where("is_gross_sale")))


@query("output_violations")
def output_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = work(spark, sf_dir)
    facts = etl.sales_facts(w)
    return etl.output_violations(facts, etl.customer_features(facts, w), etl.returns_log(w, facts))


@query("etl_summary")
def etl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = work(spark, sf_dir)
    facts = etl.sales_facts(w)
    return etl.etl_summary(w, facts, etl.returns_log(w, facts))


@query("feature_profile")
def feature_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = work(spark, sf_dir)
    features = etl.customer_features(etl.sales_facts(w), w)
    return profile.numeric_profile(
        features, ["recency_days", "frequency", "monetary", "unique_products"]
    )


_PUBLISHED: dict[tuple[str, str], str] = {}


def published(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the three tables that the ETL job publishes, written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED:
        _PUBLISHED[key] = fresh_folder(spark, "published")
        retail_etl.run(lines(spark, sf_dir), _PUBLISHED[key])
    return _PUBLISHED[key]


for table_name in ("sales_facts", "customer_features", "returns_log"):
    QUERIES[f"published_{table_name}"] = lambda spark, sf_dir, name=table_name: retail_etl.read_published(spark, published(spark, sf_dir), name)[name]


@query("published_checks")
def published_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules as they were counted while the published tables were written."""
    return retail_etl.read_checks(spark, published(spark, sf_dir))


# --- marketplace -----------------------------------------------------------------------------


def on_market(name: str, operator: Callable[[dict[str, DataFrame]], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(bindings.marketplace(spark, sf_dir))


def _fan(t: dict[str, DataFrame], operator) -> DataFrame:
    chosen = mk.filtered_orders(t["orders"], t["customers"], CITY, FANOUT_SINCE)
    return operator(chosen, t["order_items"], t["order_reviews"])


on_market(
    "translation_gap",
    lambda t: mk.translation_gap(t["products"], t["product_category_name_translation"]),
)
on_market("monthly_metrics", lambda t: mk.monthly_metrics(t["orders"], t["order_items"]))
on_market(
    "top_sellers",
    lambda t: mk.top_sellers(
        mk.seller_metrics(t["orders"], t["order_items"], t["order_reviews"], t["sellers"], SELLER_YEAR)
    ),
)
on_market("fanout_naive", lambda t: _fan(t, mk.fanout_naive))
on_market("fanout_safe", lambda t: _fan(t, mk.fanout_safe))
on_market(
    "fanout_inflation",
    lambda t: _fan(t, mk.fanout_inflation),
)
on_market("city_search", lambda t: mk.city_search(t["customers"], CITY))


_CSV: dict[tuple[str, str, str], str] = {}


def csv_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named ones of the nine tables, all if none is named, written as compressed CSV, each once, and read back typed."""
    paths, tables = {}, bindings.marketplace(spark, sf_dir)
    for name in names or tables:
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in _CSV:
            path = f"{fresh_folder(spark, 'marketplace')}/{name}"
            files.write_csv(tables[name], path, "gzip")
            _CSV[key] = path
        paths[name] = _CSV[key]
    return files.read_marketplace(spark, paths)


def csv_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = csv_tables(spark, sf_dir, name)[name]
    return rows.withColumns({f.name: F.col(f.name).cast("double") for f in rows.schema if f.dataType.typeName() == "decimal"})


# Whole rows of the three largest tables, as they come out of CSV.
for table_name in ("orders", "order_items", "order_reviews"):
    QUERIES[f"{table_name}_csv"] = lambda spark, sf_dir, name=table_name: csv_rows(spark, sf_dir, name)


@query("retail_csv")
def retail_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail lines written as CSV and read back typed."""
    folder = fresh_folder(spark, "retail-csv")
    files.write_csv(lines(spark, sf_dir), folder)
    return files.read_retail(spark, folder, "csv", line_breaks=True)


@query("order_source")
def order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine tables out of CSV, counted."""
    out = None
    for name, df in csv_tables(spark, sf_dir).items():
        row = df.agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("rows"),
            F.count(df.columns[-1]).alias("last_column_present"),
            F.min(F.col(df.columns[0])).alias("first_key"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def snapshot_totals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Daily totals of the order headers, and of a snapshot that lags behind: other orders, statuses, values and reviews."""
    t = bindings.marketplace(spark, sf_dir)
    paid = t["order_payments"].select("order_id", F.col("payment_value").alias("price"))
    source = mk.day_totals(t["orders"], paid, t["order_reviews"])
    late = bindings.served_snapshot(t)
    return source, mk.day_totals(late["orders"], late["order_items"], late["order_reviews"])


@query("reconcile")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mk.reconcile(*snapshot_totals(spark, sf_dir))


@query("reconcile_stream")
def reconcile_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same out of two streams of daily totals, whose days arrive year by year."""
    folder = fresh_folder(spark, "reconcile")
    sides = {name: stored(df, f"totals-{name}") for name, df in zip(("source", "served"), snapshot_totals(spark, sf_dir), strict=True)}
    span = sides["source"].agg(F.year(F.min("day")).alias("first"), F.year(F.max("day")).alias("last")).first()
    # A row of no totals on either side closes the last days; it is not part of the result.
    closing = f"{(span['last'] or 0) + 2:04}-01-01"
    for year in range(span["first"] or 0, (span["last"] or -1) + 2):
        for name, totals in sides.items():
            end = spark.range(1).select(F.lit(closing).cast("date").alias("day")) if year > span["last"] else spark.range(0).select(F.lit(None).cast("date").alias("day"))
            rows = totals.where(F.year("day") == year).unionByName(end, allowMissingColumns=True)
            rows.write.parquet(f"{folder}/{name}/year={year}")
        streams = [spark.readStream.schema(df.schema).parquet(f"{folder}/{name}/year=*") for name, df in sides.items()]
        reconciliation.reconcile_job(*streams, f"{folder}/days", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/days").where(F.col("day") != closing)


# --- review texts ----------------------------------------------------------------------------

SAMPLE_SIZE = 300


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's documents as reviews, staged once for all queries."""
    return staged(spark, "reviews", sf_dir, lambda: bindings.reviews(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-score reviews with their normalised text, staged once. They come straight out of the documents: the reviews that are
    not low are never written."""
    return staged(spark, "records", sf_dir, lambda: rv.review_records(bindings.reviews(spark, sf_dir)))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct texts with their routes, staged once."""
    return staged(spark, "texts", sf_dir, lambda: rv.route_texts(rv.dedup_texts(records(spark, sf_dir))))


def on_records(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(records(spark, sf_dir))


def on_texts(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(texts(spark, sf_dir))


def routed(spark: SparkSession, sf_dir: str) -> extraction.Routed:
    """Reviews and routed texts, for the queries behind the routes."""
    return extraction.Routed(records(spark, sf_dir), texts(spark, sf_dir))


_RUNS: dict[tuple, extraction.Extraction] = {}


def answered(
    spark: SparkSession, sf_dir: str, cap_usd: float | None = None
) -> tuple[extraction.Routed, extraction.Extraction]:
    """A run with model answers; its tables are written once for the queries on them."""
    known = routed(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, cap_usd)
    if key not in _RUNS:
        _RUNS[key] = extraction.with_answers(known.texts, bindings.model_answers(known.texts), cap_usd)
    return known, _RUNS[key]


def on_answers(name: str, operator, cap_usd: float | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(*answered(spark, sf_dir, cap_usd))


def _expanded(routed: extraction.Routed, run: extraction.Extraction) -> DataFrame:
    return rs.expand_reviews(routed.records, run.results)


QUERIES["low_score_reviews"] = lambda spark, sf_dir: rv.low_score_reviews(
    reviews(spark, sf_dir)
)
on_records("review_raw_text", lambda r: r.select("review_id", "raw_text"))
on_records("normalized_text", lambda r: r.select("review_id", "normalized_text"))
on_records("text_hash", lambda r: r.select("review_id", "text_hash"))
on_records("dedup_groups", lambda r: rv.dedup_texts(r).drop("normalized_text"))
on_records("duplicate_text_top", rv.duplicate_text_top)
on_records("duplicate_text_stats", rv.duplicate_text_stats)
on_records(
    "text_length_profile",
    lambda r: profile.numeric_profile(r.select(F.length("raw_text").alias("length")), ["length"]),
)
on_texts(
    "rule_issues",
    lambda t: rv.exploded_issues(
        t.where(F.col("issues").isNotNull()), "dedup_key", "needs_manual_review"
    ),
)
on_texts("route", lambda t: t.select("dedup_key", "route", "reason", "n_reviews"))
on_texts("route_counts", rv.route_counts)
on_texts(
    "token_estimate",
    lambda t: t.select("dedup_key", budget.estimate_tokens(F.col("raw_text")).alias("tokens")),
)
on_texts("route_sample", lambda t: budget.route_sample(t, SAMPLE_SIZE).select("dedup_key", "route"))


@query("near_duplicates")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of similar texts among the distinct ones. Unless another query has staged the texts, they come straight out of the
    documents: raw texts and routes, which take more room than all the rest, are not asked for here and so not written."""
    if is_staged(spark, "texts", sf_dir):
        return near_texts.near_duplicates(texts(spark, sf_dir))
    records_ = rv.review_records(bindings.reviews(spark, sf_dir))
    return near_texts.near_duplicates(rv.route_texts(rv.dedup_texts(records_)))


@query("token_batches")
def token_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.pack_batches(budget.small_items(routed(spark, sf_dir).texts))


@query("budget_gate")
def budget_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.call_plan(routed(spark, sf_dir).texts)


@query("offline_results")
def offline_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rv.exploded_issues(
        rs.offline_results(texts(spark, sf_dir)), "dedup_key", "method", "needs_manual_review"
    )


@query("response_validation")
def response_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = routed(spark, sf_dir).texts
    judged = rs.validate_responses(bindings.model_answers(known), known)
    return judged.select(
        "dedup_key", "tier", "status", F.size("issues").alias("issues"), "needs_manual_review"
    ).withColumn("issues", F.when(F.col("issues") >= 0, F.col("issues")))


on_answers("escalation", lambda routed, run: rs.escalation(run.outcomes))
def _merged(routed: extraction.Routed, run: extraction.Extraction) -> DataFrame:
    return rv.exploded_issues(run.results, "dedup_key", "method", "model", "needs_manual_review")


on_answers("merged_results", _merged)
on_answers("merged_results_capped", _merged, fv.DEFAULT_COST_CAP_USD)
on_answers(
    "expanded_reviews",
    lambda routed, run: rv.exploded_issues(
        _expanded(routed, run),
        "review_id", "order_id", "review_score", "raw_text", "normalized_text_hash", "method",
        "model", "needs_manual_review", "actionable_for_seller",
    ),
)
on_answers("issue_counts", lambda routed, run: rs.issue_counts(routed.texts, run.results))
on_answers("method_counts", lambda routed, run: rs.method_counts(routed.texts, run.results))
on_answers(
    "accuracy_sample", lambda routed, run: evaluation.accuracy_sample(_expanded(routed, run))
)
for name, cap in (("extraction_metadata", None), ("extraction_metadata_capped", fv.DEFAULT_COST_CAP_USD)):
    on_answers(name, lambda routed, run: extraction.metadata(routed, run, run.results), cap)
_RESULTS: dict[tuple[str, str], str] = {}


def written_results(spark: SparkSession, sf_dir: str) -> str:
    """Where the results of the run with answers were written as JSON lines, once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RESULTS:
        known, run = answered(spark, sf_dir)
        folder = fresh_folder(spark, "review-results")
        files.write_review_results(_expanded(known, run), extraction.metadata(known, run, run.results), folder)
        _RESULTS[key] = folder
    return _RESULTS[key]


@query("results_json")
def results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written results read back and checked line by line, one row per issue."""
    results = files.read_review_results(spark, written_results(spark, sf_dir))
    files.require_sound_results(results)
    return rv.exploded_issues(
        results, "review_id", "order_id", "review_score", "raw_text", "normalized_text_hash", "method",
        "model", "needs_manual_review", "actionable_for_seller",
    )


@query("metadata_json")
def metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_run_metadata(spark, written_results(spark, sf_dir))


QUERIES["accuracy_metrics"] = lambda spark, sf_dir: evaluation.accuracy_metrics(
    bindings.judged_reviews(bindings.table(spark, sf_dir, "labels"))
)


@query("cache_misses")
def cache_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All low-score reviews against a cache of those whose text a rule settles."""
    known = routed(spark, sf_dir)
    settled = known.texts.where(F.col("route") == "rule")
    cache = settled.select(
        "review_id", F.col("dedup_key").alias("text_hash"), F.lit("v1").alias("model_version")
    )
    return rv.cache_misses(known.records, cache, "v1").select("review_id", "text_hash")


# --- streams ---------------------------------------------------------------------------------


def dealt_events(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The events as a stream of several micro-batches that arrive out of order: a remainder of the event id
    names the files, so each batch reaches over all days and most of its events are late."""
    events = bindings.table(spark, sf_dir, "events")
    tasks = events.rdd.getNumPartitions()
    events.withColumn("part", F.pmod("event_id", F.lit(ARRIVALS))).write.partitionBy("part").parquet(f"{folder}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", tasks).parquet(f"{folder}/events/part=*")
    return bindings.order_events(stream)


def local_times(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def event_log(spark: SparkSession, sf_dir: str, folder: str) -> str:
    so.log_job(dealt_events(spark, sf_dir, folder), f"{folder}/log", f"{folder}/log-checkpoint")
    return f"{folder}/log"


def arriving_events(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[DataFrame]:
    """The stream of the events after each arrival: a remainder of the event id says when an event comes, so every
    arrival reaches over all days and most of its events are late."""
    events = bindings.table(spark, sf_dir, "events")
    for part in range(ARRIVALS):
        events.where(F.pmod("event_id", F.lit(ARRIVALS)) == part).write.parquet(f"{folder}/events/part={part}")
        yield bindings.order_events(spark.readStream.schema(events.schema).parquet(f"{folder}/events/part=*"))


def seller_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival is a micro-batch of all three jobs."""
    folder = fresh_folder(spark, "seller-days")
    for events in arriving_events(spark, sf_dir, folder):
        so.log_job(events, f"{folder}/log", f"{folder}/log-checkpoint")
        so.accepted_job(events, f"{folder}/accepted", f"{folder}/accepted-checkpoint")
        so.seller_daily_job(so.log_stream(spark, f"{folder}/accepted"), f"{folder}/days", f"{folder}/days-checkpoint")
    late = so.late_events(so.log_table(spark, f"{folder}/log"), so.log_table(spark, f"{folder}/accepted"))
    return so.current_seller_days(spark, f"{folder}/days", late)


@query("latest_status")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final state of the status stream, which follows the log over several micro-batches."""
    folder = fresh_folder(spark, "status")
    log = so.log_stream(spark, event_log(spark, sf_dir, folder), FILES_PER_BATCH).drop("event_date")
    so.status_job(log, f"{folder}/status", f"{folder}/status-checkpoint")
    return local_times(so.current_status(spark, f"{folder}/status"), "event_time", "estimated_delivery_date")


@query("late_events")
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that came behind the watermark of their arrival."""
    folder = fresh_folder(spark, "late-events")
    for events in arriving_events(spark, sf_dir, folder):
        so.log_job(events, f"{folder}/log", f"{folder}/log-checkpoint")
        so.accepted_job(events, f"{folder}/accepted", f"{folder}/accepted-checkpoint")
    late = so.late_events(so.log_table(spark, f"{folder}/log"), so.log_table(spark, f"{folder}/accepted"))
    return local_times(late.select("event_id", "event_time", "order_id", "status"), "event_time")


@query("seller_daily")
def seller_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final state of the seller day stream, which follows the log over several micro-batches."""
    days = seller_days(spark, sf_dir)
    return days.withColumns(
        {"day": F.to_date("day").cast("string"), "amount": F.col("amount").cast("double")}
    )


@query("monthly_curve")
def monthly_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return so.monthly_curve(seller_days(spark, sf_dir))


@query("late_alerts")
def late_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overdue orders after several micro-batches that arrive out of order."""
    folder = fresh_folder(spark, "late")
    so.progress_job(dealt_events(spark, sf_dir, folder), f"{folder}/progress", f"{folder}/checkpoint")
    return local_times(so.current_alerts(spark, f"{folder}/progress"), "due")


@query("dead_letters")
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that do not parse, beside the number of those that do."""
    folder = fresh_folder(spark, "split")
    so.split_job(dealt_events(spark, sf_dir, f"{folder}/arrivals"), folder, f"{folder}/checkpoint")
    good = spark.read.parquet(f"{folder}/good").agg(F.count(F.lit(1)).alias("n")).scalar()
    dead = spark.read.parquet(f"{folder}/dead").select("event_id", "event_time", "payload")
    return local_times(dead, "event_time").withColumn("readable_events", good)


@query("stream_reviews")
def stream_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed texts of the review stream over several arrivals; later ones bring some earlier reviews again."""
    folder = fresh_folder(spark, "reviews")
    documents = bindings.table(spark, sf_dir, "documents")
    arrival = F.pmod("doc_id", F.lit(ARRIVALS))
    for part in range(ARRIVALS):
        sent = documents.where((arrival == part) | ((arrival < part) & (F.col("doc_id") % 7 == 0)))
        sent.write.parquet(f"{folder}/documents/part={part}")
        stream = spark.readStream.schema(documents.schema).parquet(f"{folder}/documents/part=*")
        sr.review_job(bindings.document_reviews(stream), folder, f"{folder}/checkpoint", "v1")
    return sr.current_texts(spark, folder).select("dedup_key", "review_id", "route", "needs_manual_review", "tokens")

"""Data-quality profiles of retail lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.numeric import MONEY, count_where, money_sum, n_rows, pct, ratio, round_half_even
from ..functions.quantiles import exact_quantiles, quantile_columns
from ..functions.text import strip_space


def is_positive() -> Column:
    return (F.col("quantity") > 0) & (F.col("price") > 0)


def amount() -> Column:
    return F.col("line_amount")


def _sum_where(condition: Column, value: Column) -> Column:
    return money_sum(F.when(condition, value))


def positive_anonymous(work: DataFrame) -> DataFrame:
    return work.where(F.col("is_customer_missing") & is_positive())


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


# --- extremes and price issues ---------------------------------------------------------------


def quantity_extremes(work: DataFrame) -> DataFrame:
    """Rows whose quantity is the largest or the smallest of all."""
    bounds = work.agg(F.max("quantity").alias("hi"), F.min("quantity").alias("lo"))
    at_bound = (F.col("quantity") == bounds.select("hi").scalar()) | (
        F.col("quantity") == bounds.select("lo").scalar()
    )
    return work.where(at_bound).select(
        "invoice",
        "stock_code",
        "description",
        "quantity",
        "invoice_datetime",
        "price",
        "customer_id_raw",
        "country",
        "line_amount",
    )


def extreme_gap_minutes(extremes: DataFrame) -> DataFrame:
    """Minutes between the two extreme rows; null unless there are exactly two."""
    micros = F.unix_micros(F.col("invoice_datetime").cast("timestamp"))
    gap = (F.max(micros) - F.min(micros)).cast("double") / 60e6
    return extremes.agg(
        n_rows().alias("rows"), F.when(n_rows() == 2, gap).alias("minutes_between")
    )


def negative_price_rows(work: DataFrame) -> DataFrame:
    return work.where(F.col("price") < 0).select(
        "invoice",
        "stock_code",
        "description",
        "quantity",
        "invoice_datetime",
        "price",
        "customer_id_raw",
        "country",
        "line_amount",
    )


def price_issue_counts(work: DataFrame) -> DataFrame:
    counts = work.agg(
        count_where(F.col("price") < 0).alias("Price < 0"),
        count_where(F.col("price") == 0).alias("Price = 0"),
        count_where(F.col("is_damage")).alias("Damage / inventory loss: Price = 0 and Quantity < 0"),
    )
    return counts.unpivot([], counts.columns, "issue", "rows")


def missing_description_audit(work: DataFrame) -> DataFrame:
    negative = count_where(F.col("quantity") < 0)
    return work.where("is_description_missing").agg(
        n_rows().alias("rows"),
        count_where(F.col("price") == 0).alias("price_zero_rows"),
        count_where(F.col("is_customer_missing")).alias("customer_missing_rows"),
        negative.alias("negative_quantity_rows"),
        pct(negative, n_rows()).alias("negative_quantity_pct"),
    )


def high_price_items(work: DataFrame, p: float = 0.99, limit: int = 15) -> DataFrame:
    """Codes of anonymous positive lines priced above the p-quantile of those lines."""
    anonymous = positive_anonymous(work)
    threshold = exact_quantiles(anonymous, "price", [p]).select("quantile").scalar()
    groups = (
        anonymous.where((F.col("price") > threshold) & F.col("description").isNotNull())
        .groupBy("stock_code", "description")
        .agg(n_rows().alias("rows"), round_half_even(ratio(money_sum(F.col("price")), n_rows()), 2).alias("avg_price"))
    )
    return top_rows(groups, [F.desc("rows"), F.asc("stock_code"), F.asc("description")], limit)


# --- column profiles -------------------------------------------------------------------------


def null_report(df: DataFrame) -> DataFrame:
    """Missing rows per column, one pass."""
    total = df.agg(*[count_where(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns], n_rows().alias("_n"))
    kinds = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    return total.unpivot(["_n"], df.columns, "column", "missing_rows").select(
        "column",
        kinds[F.col("column")].alias("dtype"),
        "missing_rows",
        pct(F.col("missing_rows"), F.col("_n")).alias("missing_pct"),
    )


def _stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.select([F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "v").where(F.col("v").isNotNull())


def numeric_profile(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """count, mean, sample std, min, quantiles and max per column, as rows."""
    tall = _stacked(df, columns)
    stats = tall.groupBy("column").agg(
        n_rows().cast("double").alias("count"),
        round_half_even(F.avg("v"), 2).alias("mean"),
        round_half_even(F.stddev_samp("v"), 2).alias("std"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
    ).unpivot(["column"], ["count", "mean", "std", "min", "max"], "metric", "value")
    quantiles = exact_quantiles(tall, "v", probs, ["column"]).select(
        "column",
        F.concat(F.round(F.col("p") * 100, 0).cast("int").cast("string"), F.lit("%")).alias("metric"),
        round_half_even(F.col("quantile"), 2).alias("value"),
    )
    return stats.unionByName(quantiles)


def string_profile(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """Distinct values and the most frequent ones per text column."""
    tall = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = tall.groupBy("column", "value").agg(n_rows().alias("n"))
    distinct = counts.groupBy("column").agg(F.count("value").alias("unique_values"))
    shown = F.coalesce("value", F.lit("<missing>"))
    rank = Window.partitionBy("column").orderBy(F.desc("n"), F.col("shown"))
    # Spark keeps at most ``top`` rows per column in each map task before it shuffles for the rank.
    best = (
        counts.select("column", "n", shown.alias("shown"))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= top)
    )
    entry = F.struct("rank", F.concat_ws(": ", "shown", F.col("n").cast("string")).alias("t"))
    listed = best.groupBy("column").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["t"]), "; ").alias(
            "top_10_values"
        )
    )
    return distinct.join(listed, "column")


# --- invoices and codes ----------------------------------------------------------------------


def invoice_prefix_summary(work: DataFrame) -> DataFrame:
    return work.groupBy("invoice_prefix").agg(
        n_rows().alias("rows"),
        F.count_distinct("invoice").alias("invoices"),
        F.sum("quantity").alias("quantity_sum"),
        money_sum(amount()).alias("amount_sum"),
        count_where(F.col("quantity") < 0).alias("negative_quantity_rows"),
        count_where(F.col("price") < 0).alias("negative_price_rows"),
        count_where(F.col("price") == 0).alias("zero_price_rows"),
        count_where(F.col("is_customer_missing")).alias("missing_customer_rows"),
    )


def bad_debt_rows(work: DataFrame) -> DataFrame:
    return work.where("is_bad_debt").select(
        "invoice", "stock_code", "description", "quantity", "invoice_datetime", "price",
        "customer_id_raw", "country", "line_amount",
    )


def stock_category_summary(work: DataFrame) -> DataFrame:
    """Per category; there are eight, so the shares come from a window over eight rows."""
    groups = work.groupBy("stock_category").agg(
        n_rows().alias("rows"),
        F.count_distinct("stock_code").alias("distinct_codes"),
        F.sum(amount().cast(MONEY)).alias("amount"),
    )
    everything = Window.partitionBy()
    return groups.select(
        "stock_category",
        "rows",
        "distinct_codes",
        F.col("amount").cast("double").alias("amount_sum"),
        pct(F.col("rows"), F.sum("rows").over(everything), 3).alias("row_pct"),
        pct(F.col("amount"), F.sum("amount").over(everything), 3).alias("amount_pct"),
    )


def non_product_codes(work: DataFrame) -> DataFrame:
    """Every code that is not a product, beside the number of codes in its category.

    One row per code: a category may hold any number of them.
    """
    codes = (
        work.where(~F.col("is_product_like"))
        .groupBy("stock_category", "stock_code")
        .agg(n_rows().alias("rows"))
    )
    sizes = codes.groupBy("stock_category").agg(n_rows().alias("distinct_codes"))
    return codes.join(F.broadcast(sizes), "stock_category").select(
        F.col("stock_category").alias("category"), "distinct_codes", "stock_code", "rows"
    )


def item_description(work: DataFrame) -> DataFrame:
    """Most frequent trimmed description per product code; ties go to the first in order."""
    counts = (
        work.where(F.col("is_gross_sale") & F.col("description").isNotNull())
        .groupBy("stock_code", strip_space(F.col("description")).alias("description"))
        .agg(n_rows().alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), "description"))
    return counts.groupBy("stock_code").agg(best["description"].alias("description"))


def all_missing_description_codes(work: DataFrame) -> DataFrame:
    missing = count_where(F.col("is_description_missing"))
    return (
        work.groupBy("stock_code")
        .agg(
            n_rows().alias("rows"),
            missing.alias("missing_description_rows"),
            (missing == n_rows()).alias("all_description_missing"),
            F.min("stock_category").alias("stock_code_category"),
        )
        .where("all_description_missing")
    )


def description_conflicts(work: DataFrame) -> DataFrame:
    """Codes with more than one distinct description after trimming and upper-casing."""
    norm = F.upper(strip_space(F.col("description")))
    return (
        work.where(F.col("description").isNotNull())
        .groupBy("stock_code")
        .agg(F.count_distinct(norm).alias("distinct_descriptions"), n_rows().alias("rows"))
        .where("distinct_descriptions > 1")
    )


def code_descriptions(work: DataFrame, code: str) -> DataFrame:
    """Descriptions in use for one code, missing ones included."""
    return (
        work.where(F.col("stock_code") == code)
        .groupBy(F.upper(strip_space(F.col("description"))).alias("description"))
        .agg(n_rows().alias("rows"), money_sum(amount()).alias("amount_sum"))
    )


def damage_descriptions(work: DataFrame, limit: int = 20) -> DataFrame:
    text = F.upper(F.coalesce("description", F.lit("<missing>")))
    groups = work.where("is_damage").groupBy(text.alias("description")).agg(n_rows().alias("rows"))
    return top_rows(groups, [F.desc("rows"), F.asc("description")], limit)


# --- missing customers -----------------------------------------------------------------------


def customer_missing_summary(work: DataFrame) -> DataFrame:
    """Lines without and with a customer, side by side."""
    label = F.when(F.col("is_customer_missing"), "Customer ID missing").otherwise("Customer ID present")
    tagged = work.withColumn("segment", label)
    groups = tagged.groupBy("segment").agg(
        n_rows().alias("rows"),
        F.sum(amount().cast(MONEY)).alias("amount"),
        count_where(F.col("country") == "United Kingdom").alias("uk"),
        count_where(is_positive()).alias("positive_qty_price_rows"),
        count_where(F.col("is_damage")).alias("damage_loss_rows"),
    )
    medians = quantile_columns(tagged, "line_amount", {"median_line_amount": 0.5}, ["segment"])
    both = Window.partitionBy()
    return groups.join(medians, "segment").select(
        "segment",
        "rows",
        pct(F.col("rows"), F.sum("rows").over(both)).alias("row_pct"),
        F.col("amount").cast("double").alias("amount_sum"),
        pct(F.col("amount"), F.sum("amount").over(both)).alias("amount_pct_of_net"),
        round_half_even(ratio(F.col("amount"), F.col("rows")), 2).alias("avg_line_amount"),
        round_half_even(F.col("median_line_amount"), 2).alias("median_line_amount"),
        pct(F.col("uk"), F.col("rows")).alias("uk_pct"),
        "positive_qty_price_rows",
        "damage_loss_rows",
    )


def customer_missing_buckets(work: DataFrame) -> DataFrame:
    """Five independent views of the lines without a customer; a line may be in several or none."""
    free = (F.col("price") == 0) & (F.col("quantity") > 0)
    views = [is_positive(), F.col("is_damage"), free, F.col("is_cancellation"), F.col("is_bad_debt")]
    masks = dict(zip(fv.MISSING_CUSTOMER_BUCKETS, views, strict=True))
    cells = [
        F.struct(
            F.lit(label).alias("bucket"),
            count_where(mask).alias("rows"),
            pct(count_where(mask), n_rows()).alias("pct_of_missing_rows"),
            _sum_where(mask, amount()).alias("amount_sum"),
        )
        for label, mask in masks.items()
    ]
    return work.where("is_customer_missing").agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def invoice_levels(work: DataFrame) -> DataFrame:
    """One row per invoice: how complete its customer is, and what it holds."""
    missing = count_where(F.col("is_customer_missing"))
    pattern = (
        F.when(missing == 0, "all_present")
        .when(missing == n_rows(), "all_missing")
        .otherwise("mixed_missing_present")
    )
    return work.groupBy("invoice").agg(
        n_rows().alias("rows"),
        missing.alias("missing_customer_rows"),
        F.sum(amount().cast(MONEY)).alias("amount"),
        F.bool_or(F.upper("stock_code") == "DOT").alias("has_dot"),
        F.bool_or("is_damage").alias("has_damage"),
        F.bool_or(F.col("is_customer_missing") & is_positive()).alias("has_positive_missing"),
        pattern.alias("customer_id_pattern"),
    )


def invoice_completeness(work: DataFrame) -> DataFrame:
    groups = invoice_levels(work).groupBy("customer_id_pattern").agg(
        n_rows().alias("invoices"),
        F.sum("rows").alias("rows"),
        F.sum("amount").cast("double").alias("amount_sum"),
        count_where(F.col("has_dot")).alias("dotcom_postage_invoices"),
        count_where(F.col("has_damage")).alias("damage_loss_invoices"),
    )
    patterns = Window.partitionBy()
    return groups.withColumns(
        {
            "invoice_pct": pct(F.col("invoices"), F.sum("invoices").over(patterns)),
            "row_pct": pct(F.col("rows"), F.sum("rows").over(patterns)),
        }
    )


def anonymous_invoice_patterns(work: DataFrame) -> DataFrame:
    """Completeness of the invoices that hold a positive line without a customer."""
    groups = (
        invoice_levels(work)
        .where("has_positive_missing")
        .groupBy("customer_id_pattern")
        .agg(n_rows().alias("invoices"))
    )
    return groups.withColumn(
        "pct", pct(F.col("invoices"), F.sum("invoices").over(Window.partitionBy()))
    )


def mixed_invoices(work: DataFrame) -> DataFrame:
    """Invoices that mix lines with and without a customer and hold a positive line without one."""
    levels = invoice_levels(work)
    return levels.where(
        (F.col("customer_id_pattern") == "mixed_missing_present") & F.col("has_positive_missing")
    ).select(
        "invoice",
        F.col("rows").alias("total_rows"),
        (F.col("rows") - F.col("missing_customer_rows")).alias("present_customer"),
        F.col("missing_customer_rows").alias("missing_customer"),
    )


def dot_share_of_missing_invoices(work: DataFrame) -> DataFrame:
    """Share of invoices without any customer that carry the online postage code."""
    return (
        invoice_levels(work)
        .where(F.col("customer_id_pattern") == "all_missing")
        .agg(
            n_rows().alias("invoices"),
            count_where(F.col("has_dot")).alias("dot_invoices"),
            pct(count_where(F.col("has_dot")), n_rows()).alias("dot_pct"),
        )
    )


def missing_customer_overlap(work: DataFrame) -> DataFrame:
    """How far losses and missing descriptions coincide with missing customers."""
    missing = F.col("is_customer_missing")
    damage, no_text = F.col("is_damage"), F.col("is_description_missing")
    return work.agg(
        count_where(damage & missing).alias("damage_missing_rows"),
        count_where(damage).alias("damage_rows"),
        pct(count_where(damage & missing), count_where(missing)).alias("damage_pct_of_missing"),
        count_where(no_text & missing).alias("no_description_missing_rows"),
        count_where(no_text).alias("no_description_rows"),
    )


def top_anonymous_items(work: DataFrame, limit: int = 15) -> DataFrame:
    """Most frequent code and description pairs without a customer; missing descriptions count."""
    groups = (
        work.where("is_customer_missing")
        .groupBy("stock_code", "description")
        .agg(
            n_rows().alias("rows"),
            money_sum(amount()).alias("amount_sum"),
            F.sum("quantity").alias("quantity_sum"),
        )
    )
    order = [F.desc("rows"), F.asc("stock_code"), F.asc_nulls_first("description")]
    return top_rows(groups, order, limit)


def top_positive_anonymous_items(work: DataFrame, limit: int = 20) -> DataFrame:
    """The same for positive lines, with shares, invoices and mean price."""
    lines = positive_anonymous(work)
    totals = lines.agg(n_rows().alias("n"), F.sum(amount().cast(MONEY)).alias("a"))
    groups = lines.groupBy("stock_code", "description").agg(
        n_rows().alias("rows"),
        F.sum(amount().cast(MONEY)).alias("amount"),
        F.sum("quantity").alias("quantity_sum"),
        F.count_distinct("invoice").alias("invoices"),
        round_half_even(ratio(money_sum(F.col("price")), n_rows()), 2).alias("avg_price"),
    )
    order = [F.desc("rows"), F.asc("stock_code"), F.asc_nulls_first("description")]
    best = top_rows(groups, order, limit)
    return best.select(
        "stock_code",
        "description",
        "rows",
        F.col("amount").cast("double").alias("amount_sum"),
        "quantity_sum",
        "invoices",
        "avg_price",
        pct(F.col("rows"), totals.select("n").scalar()).alias("row_pct"),
        pct(F.col("amount"), totals.select("a").scalar()).alias("amount_pct"),
    )


def anonymous_by_country(work: DataFrame) -> DataFrame:
    lines = positive_anonymous(work)
    totals = lines.agg(n_rows().alias("n"), F.sum(amount().cast(MONEY)).alias("a"))
    groups = lines.where(F.col("country").isNotNull()).groupBy("country").agg(
        n_rows().alias("rows"),
        F.sum(amount().cast(MONEY)).alias("amount"),
        F.count_distinct("invoice").alias("invoices"),
    )
    return groups.select(
        "country",
        "rows",
        F.col("amount").cast("double").alias("amount_sum"),
        "invoices",
        pct(F.col("rows"), totals.select("n").scalar()).alias("row_pct"),
        pct(F.col("amount"), totals.select("a").scalar()).alias("amount_pct"),
    )


def rows_per_invoice_hist(work: DataFrame) -> DataFrame:
    """How many invoices have how many positive lines without a customer."""
    sizes = positive_anonymous(work).groupBy("invoice").agg(n_rows().alias("rows_per_invoice"))
    return sizes.groupBy("rows_per_invoice").agg(n_rows().alias("invoice_count"))


def rows_per_invoice_profile(work: DataFrame) -> DataFrame:
    sizes = positive_anonymous(work).groupBy("invoice").agg(n_rows().alias("rows_per_invoice"))
    return numeric_profile(sizes, ["rows_per_invoice"])


def anonymous_by_month(work: DataFrame) -> DataFrame:
    lines = positive_anonymous(work)
    total = lines.agg(n_rows().alias("n")).scalar()
    at = F.col("invoice_datetime")
    groups = lines.groupBy(
        F.year(at).alias("year"), F.quarter(at).alias("quarter"), F.month(at).alias("month")
    ).agg(
        n_rows().alias("rows"),
        money_sum(amount()).alias("amount_sum"),
        F.count_distinct("invoice").alias("invoices"),
    )
    return groups.withColumn("row_pct", pct(F.col("rows"), total))


def month_totals(work: DataFrame, last: int | None = None) -> DataFrame:
    """Rows and amount per month, or of the last months only."""
    groups = work.groupBy(F.date_format("invoice_datetime", "yyyy-MM").alias("month")).agg(
        n_rows().alias("rows"), money_sum(amount()).alias("amount_sum")
    )
    return groups if last is None else top_rows(groups, [F.desc("month")], last)


def amount_buckets(work: DataFrame) -> DataFrame:
    """Positive anonymous lines by right-closed amount bins; empty bins stay."""
    lines = positive_anonymous(work)
    edges = [*fv.AMOUNT_BINS, None]
    cells = []
    for label, low, high in zip(fv.AMOUNT_LABELS, edges[:-1], edges[1:]):
        inside = amount() > low if high is None else (amount() > low) & (amount() <= high)
        cells.append(
            F.struct(
                F.lit(label).alias("amount_bucket"),
                count_where(inside).alias("rows"),
                _sum_where(inside, amount()).alias("amount_sum"),
                pct(count_where(inside), n_rows()).alias("row_pct"),
            )
        )
    return lines.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


# --- measures, baskets, dates, duplicates ----------------------------------------------------


def sales_measures(work: DataFrame) -> DataFrame:
    measures = work.agg(
        _sum_where(F.col("is_gross_sale"), amount()).alias("gross_product_sales"),
        _sum_where(F.col("is_net_line"), amount()).alias("net_product_sales"),
        money_sum(amount()).alias("financial_total"),
    )
    return measures.unpivot([], measures.columns, "measure", "amount")


def basket_sizes(work: DataFrame, large: int = 50) -> DataFrame:
    """Distribution of distinct products per gross-sale invoice."""
    sizes = (
        work.where("is_gross_sale")
        .groupBy("invoice")
        .agg(F.count_distinct("stock_code").alias("size"))
    )
    names = {
        "median_unique_products": 0.5,
        "p75_unique_products": 0.75,
        "p90_unique_products": 0.9,
        "p95_unique_products": 0.95,
        "p99_unique_products": 0.99,
    }
    quantiles = quantile_columns(sizes, "size", names).select(F.struct(*names).alias("q")).scalar()
    is_large = F.col("size") >= large
    totals = sizes.agg(
        n_rows().alias("gross_product_invoices"),
        F.max("size").alias("max_unique_products"),
        count_where(is_large).alias(f"invoices_with_{large}_plus_products"),
        pct(count_where(is_large), n_rows()).alias(f"pct_invoices_with_{large}_plus_products"),
    )
    return totals.withColumn("q", quantiles).select(*totals.columns, "q.*")


def duplicate_check(lines: DataFrame, work: DataFrame) -> DataFrame:
    """Exact copies beyond the first, cross counts of flags, and the date range."""
    copies = lines.groupBy(*[F.col(f"`{c}`") for c in lines.columns]).agg(n_rows().alias("n"))
    extra = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).scalar()
    no_text = F.col("is_description_missing")
    return work.agg(
        count_where(no_text).alias("description_missing_rows"),
        count_where(no_text & F.col("is_customer_missing")).alias(
            "description_missing_customer_missing_rows"
        ),
        count_where(no_text & F.col("is_damage")).alias("description_missing_damage_loss_rows"),
        F.min("invoice_datetime").alias("min_invoice_date"),
        F.max("invoice_datetime").alias("max_invoice_date"),
        n_rows().alias("_n"),
    ).select(
        extra.alias("exact_duplicate_rows"),
        pct(extra, F.col("_n")).alias("exact_duplicate_pct"),
        "description_missing_rows",
        "description_missing_customer_missing_rows",
        "description_missing_damage_loss_rows",
        "min_invoice_date",
        "max_invoice_date",
    )


def duplicate_rows(lines: DataFrame, chunk: int = 100_000) -> DataFrame:
    """All members of sets of identical rows.

    Copies are counted, not gathered: each set becomes its rows again, in chunks that spread over
    tasks, so a set of any size is fine.
    """
    names = [f"`{c}`" for c in lines.columns]
    sets = lines.groupBy(*[F.col(c) for c in names]).agg(n_rows().alias("_n")).where("_n > 1")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, F.lit(chunk).cast("bigint"))
    chunks = sets.withColumn("_start", F.explode(starts)).repartition(*[F.col(c) for c in names], "_start")
    left = F.least(F.col("_n") - F.col("_start"), F.lit(chunk)).cast("int")
    return chunks.select(*names, F.explode(F.array_repeat(F.lit(1), left)).alias("_one")).select(*names)


def date_range(work: DataFrame) -> DataFrame:
    latest = F.max("invoice_datetime")
    return work.agg(
        F.min("invoice_datetime").alias("min_invoice_date"),
        latest.alias("max_invoice_date"),
        F.date_format(latest, "yyyy-MM").alias("last_month"),
        F.dayofmonth(latest).alias("last_month_last_day_in_data"),
    )

"""Marketplace metrics. Each 1:N child is brought to order grain before it meets another."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import count_where, n_rows, ratio, round_half_up, seconds_between, share

MONEY_SUM = "decimal(38,2)"
ANY_CASE_ANY_ACCENT = "UNICODE_CI_AI"


def delivered() -> Column:
    return F.col("order_status") == "delivered"


def canceled() -> Column:
    return F.col("order_status") == "canceled"


def _rate(part: Column, whole: Column) -> Column:
    return round_half_up(share(part, whole), 2)


def translation_gap(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products per category without an English name; a missing category shows as ``NULL``.

    Products shrink to one row per category before the join.
    """
    counts = products.groupBy("product_category_name").agg(n_rows().alias("product_count"))
    return (
        counts.join(translation, "product_category_name", "left")
        .where(F.col("product_category_name").isNull() | F.col("product_category_name_english").isNull())
        .select(
            F.coalesce("product_category_name", F.lit("NULL")).alias("missing_category"),
            "product_count",
        )
    )


def monthly_metrics(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, cancellations, delivered value and delivery time per purchase month."""
    value = items.groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).cast(MONEY_SUM).alias("order_gmv")
    )
    took = F.when(
        delivered(), seconds_between(F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date"))
    )
    zero = F.lit(0).cast(MONEY_SUM)
    return (
        orders.join(value, "order_id", "left")
        .groupBy(F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month"))
        .agg(
            n_rows().alias("total_orders"),
            count_where(delivered()).alias("delivered_orders"),
            count_where(canceled()).alias("canceled_orders"),
            _rate(count_where(canceled()), n_rows()).alias("cancel_rate"),
            F.sum(F.when(delivered(), F.coalesce("order_gmv", zero)).otherwise(zero))
            .cast("double")
            .alias("delivered_gmv"),
            round_half_up(ratio(F.sum(took), F.count(took)) / 86400.0, 2).alias("avg_delivery_days"),
        )
    )


def seller_metrics(
    orders: DataFrame, items: DataFrame, reviews: DataFrame, sellers: DataFrame, year: int
) -> DataFrame:
    """Sales, customers, reviews, lateness and cancellations per seller for one purchase year.

    Reviews are averaged per order first, then over orders.
    """
    bought = orders.where(
        (F.col("order_purchase_timestamp") >= F.lit(datetime(year, 1, 1)).cast("timestamp_ntz"))
        & (F.col("order_purchase_timestamp") < F.lit(datetime(year + 1, 1, 1)).cast("timestamp_ntz"))
    ).select(
        "order_id",
        "customer_id",
        "order_status",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    # Children of other years go before they are aggregated.
    theirs = bought.select("order_id")
    scores = reviews.join(theirs, "order_id", "left_semi").groupBy("order_id").agg(
        ratio(F.sum("review_score"), F.count("review_score")).alias("order_score")
    )
    judged = bought.join(scores, "order_id", "left")
    sold = items.join(theirs, "order_id", "left_semi").groupBy("seller_id", "order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).cast(MONEY_SUM).alias("value")
    )
    arrived, due = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    judgeable = delivered() & arrived.isNotNull() & due.isNotNull()
    late = judgeable & (arrived > due)
    # Sums of doubles depend on their order, so scores are summed as decimals.
    score = F.col("order_score").cast("decimal(20,12)")
    per_seller = (
        sold.join(judged, "order_id")
        .groupBy("seller_id")
        .agg(
            F.sum(F.when(delivered(), F.col("value")).otherwise(F.lit(0).cast(MONEY_SUM)))
            .cast("double")
            .alias("gmv"),
            n_rows().alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            round_half_up(ratio(F.sum(score), F.count(score)), 2).alias("avg_review_score"),
            _rate(count_where(late), count_where(judgeable)).alias("late_delivery_rate"),
            _rate(count_where(canceled()), n_rows()).alias("cancel_rate"),
        )
    )
    return per_seller.join(sellers.select("seller_id", "seller_state"), "seller_id")


def top_sellers(metrics: DataFrame, limit: int = 20) -> DataFrame:
    """The best sellers by value with their rank inside the state.

    Whoever outsells one of these sellers in a state is among them too, so the rank over the few
    rows is the rank over all sellers.
    """
    best = metrics.orderBy(F.desc("gmv"), "seller_id").limit(limit)
    rank = F.rank().over(Window.partitionBy("seller_state").orderBy(F.desc("gmv")))
    return best.select("*", rank.alias("state_rank"))


def city_contains(city: Column, needle: str) -> Column:
    """Substring search that ignores case and accents on both sides, however they are composed."""
    return F.contains(F.collate(city, ANY_CASE_ANY_ACCENT), F.collate(F.lit(needle), ANY_CASE_ANY_ACCENT))


def city_search(customers: DataFrame, needle: str) -> DataFrame:
    return customers.where(city_contains(F.col("customer_city"), needle))


def filtered_orders(
    orders: DataFrame, customers: DataFrame, needle: str, since: datetime
) -> DataFrame:
    """Delivered orders since a day from customers whose city matches."""
    chosen = city_search(customers, needle).select("customer_id", "customer_state")
    return (
        orders.where(delivered() & (F.col("order_purchase_timestamp") >= F.lit(since).cast("timestamp_ntz")))
        .select("order_id", "customer_id")
        .join(chosen, "customer_id")
        .select("order_id", "customer_state")
    )


def _order_grain(
    filtered: DataFrame, items: DataFrame, reviews: DataFrame, all_orders: bool = False
) -> DataFrame:
    """One row per order with sums and counts of its items and its reviews.

    Unless all orders are wanted, children of other orders go before they are aggregated.
    """
    if not all_orders:
        theirs = filtered.select("order_id")
        items = items.join(theirs, "order_id", "left_semi")
        reviews = reviews.join(theirs, "order_id", "left_semi")
    per_item = items.groupBy("order_id").agg(
        F.sum("price").cast(MONEY_SUM).alias("revenue"), n_rows().alias("n_items")
    )
    per_review = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("n_scores"),
        n_rows().alias("n_reviews"),
    )
    return filtered.join(per_item, "order_id", "left").join(per_review, "order_id", "left")


def _fanout(filtered: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Per state, both reports out of one pass over the orders.

    Naive: joining items and reviews to orders side by side would repeat every price once per review
    and every score once per item. Those repeats are known at order grain, so the same figures follow
    without forming the product. Safe: revenue once per item, and the mean over orders of each order's
    mean score.
    """
    copies_of_item = F.greatest(F.coalesce("n_reviews", F.lit(1)), F.lit(1))
    copies_of_score = F.greatest(F.coalesce("n_items", F.lit(1)), F.lit(1))
    scores = F.sum(F.col("score_sum") * copies_of_score)
    n_scores = F.sum(F.col("n_scores") * copies_of_score)
    score = ratio(F.col("score_sum"), F.col("n_scores")).cast("decimal(20,12)")
    return (
        _order_grain(filtered, items, reviews)
        .groupBy("customer_state")
        .agg(
            n_rows().alias("orders"),
            F.sum(F.col("revenue") * copies_of_item).cast("double").alias("naive_revenue"),
            round_half_up(ratio(scores, n_scores), 4).alias("naive_score"),
            F.sum(F.coalesce("revenue", F.lit(0).cast(MONEY_SUM))).cast("double").alias("safe_revenue"),
            round_half_up(ratio(F.sum(score), F.count(score)), 2).alias("safe_score"),
        )
    )


def fanout_naive(filtered: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """What joining items and reviews to orders side by side would report."""
    return _fanout(filtered, items, reviews).select(
        "customer_state", "orders", F.col("naive_revenue").alias("revenue"), F.col("naive_score").alias("avg_score")
    )


def fanout_safe(filtered: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Revenue counted once per item, and the mean over orders of each order's mean score."""
    return _fanout(filtered, items, reviews).select(
        "customer_state", "orders", F.col("safe_revenue").alias("revenue"), F.col("safe_score").alias("avg_score")
    )


def fanout_inflation(filtered: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Revenue that exists only through repeated rows, per group."""
    naive = F.coalesce("naive_revenue", F.lit(0.0))
    return _fanout(filtered, items, reviews).select(
        "customer_state",
        naive.alias("naive_revenue"),
        "safe_revenue",
        round_half_up(naive - F.col("safe_revenue"), 2).alias("inflation"),
    )


def day_totals(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders, value, cancellations and reviews per purchase day."""
    grain = _order_grain(
        orders.select("order_id", "order_status", F.to_date("order_purchase_timestamp").alias("day")),
        items,
        reviews,
        all_orders=True,
    )
    return grain.groupBy("day").agg(
        n_rows().alias("orders"),
        F.sum(F.coalesce("revenue", F.lit(0).cast(MONEY_SUM))).alias("gmv"),
        count_where(canceled()).alias("canceled"),
        F.sum(F.coalesce("n_reviews", F.lit(0))).alias("reviews"),
    )


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Differences between two snapshots of daily totals; a day missing on one side counts as zero."""
    measures = ["orders", "gmv", "canceled", "reviews"]
    a = left.select("day", F.struct(*measures).alias("a"))
    b = right.select("day", F.struct(*measures).alias("b"))

    def cell(side: str, name: str) -> Column:
        return F.coalesce(F.col(f"{side}.{name}").cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)"))

    joined = a.join(b, "day", "full")
    columns = [F.to_date("day").cast("string").alias("day")]
    for name in measures:
        columns.append((cell("a", name) - cell("b", name)).cast("double").alias(f"{name}_diff"))
    rate = [F.coalesce(_rate(cell(s, "canceled"), cell(s, "orders")), F.lit(0.0)) for s in ("a", "b")]
    columns.append((rate[0] - rate[1]).alias("cancel_rate_diff"))
    out = joined.select(columns)
    return out.withColumn(
        "matches", F.forall(F.array(*[f"{m}_diff" for m in measures]), lambda d: d == 0)
    )

"""Association measures of item pairs, line flags and invoice patterns."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.numeric import count_where, n_rows, pct, ratio
from .profile import item_description

SALT_BLOCK = 64


def item_pair_rules(
    work: DataFrame, min_item_invoices: int = 200, min_pair_invoices: int = 100, large: int = 50
) -> DataFrame:
    """Pairs of items that often share a gross-sale invoice, with their association measures.

    Items that cannot reach either threshold go first. A basket with many items is split: its left
    items fall into blocks of 64 and the right items are copied per block, so the pairs of one huge
    basket are formed by many tasks. Pairs are counted before they are shuffled.
    """
    baskets = work.where("is_gross_sale").select("invoice", "stock_code").distinct()
    sizes = baskets.groupBy("invoice").agg(n_rows().alias("size"))
    invoices = sizes.agg(n_rows().alias("n")).scalar()
    items = baskets.groupBy("stock_code").agg(n_rows().alias("invoices"))
    frequent = items.where(
        F.col("invoices") >= max(min_item_invoices, min_pair_invoices)
    )
    kept = baskets.join(frequent.select("stock_code"), "stock_code", "left_semi")
    kept = kept.join(sizes, "invoice").withColumn("blocks", F.ceil(F.col("size") / SALT_BLOCK).cast("int"))
    left = kept.select(
        "invoice",
        F.col("stock_code").alias("left_code"),
        F.pmod(F.xxhash64("stock_code"), F.col("blocks")).cast("int").alias("block"),
        (F.col("size") >= large).alias("is_large"),
    )
    right = kept.select(
        "invoice",
        F.col("stock_code").alias("right_code"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    pairs = (
        left.join(right, ["invoice", "block"])
        .where(F.col("left_code") < F.col("right_code"))
        .groupBy("left_code", "right_code")
        .agg(n_rows().alias("pair_invoices"), count_where(F.col("is_large")).alias("large_pairs"))
        .where(F.col("pair_invoices") >= min_pair_invoices)
    )
    texts = item_description(work)

    def side(name: str) -> DataFrame:
        about = frequent.join(texts, "stock_code", "left")
        return about.select(
            F.col("stock_code").alias(f"{name}_code"),
            F.coalesce("description", F.lit("")).alias(f"{name}_description"),
            F.col("invoices").alias(f"{name}_n"),
        )

    both, a, b = F.col("pair_invoices"), F.col("left_n"), F.col("right_n")
    ab, ba = ratio(both, a), ratio(both, b)
    n = F.col("n")
    return (
        pairs.join(side("left"), "left_code")
        .join(side("right"), "right_code")
        .withColumn("n", invoices)
        .select(
            "left_code",
            "left_description",
            "right_code",
            "right_description",
            "pair_invoices",
            (ratio(both, n) * 100.0).alias("support_pct"),
            (ab * 100.0).alias("left_to_right_conf_pct"),
            (ba * 100.0).alias("right_to_left_conf_pct"),
            (ratio(both, n) / (ratio(a, n) * ratio(b, n))).alias("lift"),
            ((ab + ba) / 2.0 * 100.0).alias("kulczynski_pct"),
            (F.least(ab, ba) * 100.0).alias("all_confidence_pct"),
            ratio(F.abs(a - b), a + b - both).alias("imbalance_ratio"),
            pct(F.col("large_pairs"), both).alias("large_basket_pair_pct"),
        )
    )


def top_pairs_by_support(rules: DataFrame, limit: int = 12) -> DataFrame:
    return rules.orderBy(F.desc("pair_invoices"), F.desc("lift"), "left_code", "right_code").limit(limit)


def top_balanced_pairs(
    rules: DataFrame, min_all_confidence: float = 20, max_imbalance: float = 0.5, limit: int = 12
) -> DataFrame:
    return (
        rules.where(
            (F.col("all_confidence_pct") >= min_all_confidence)
            & (F.col("imbalance_ratio") <= max_imbalance)
        )
        .orderBy(F.desc("lift"), F.desc("pair_invoices"), "left_code", "right_code")
        .limit(limit)
    )


def _pair_rules(df: DataFrame, flags: dict[str, Column], kind: str, unit: str) -> DataFrame:
    """Measures of all flag pairs that occur together, from one aggregate pass.

    One conditional count per flag and per pair; rows are never multiplied.
    """
    counts = df.agg(
        n_rows().alias("n"),
        *[count_where(flag).alias(name) for name, flag in flags.items()],
        *[count_where(flags[a] & flags[b]).alias(f"{a}|{b}") for a, b in combinations(flags, 2)],
    )
    both, left, right, n = (F.col(c) for c in ("both", "l", "r", "n"))
    cells = [
        F.struct(
            F.lit(a).alias("left"),
            F.lit(b).alias("right"),
            F.col(f"`{a}`").alias("l"),
            F.col(f"`{b}`").alias("r"),
            F.col(f"`{a}|{b}`").alias("both"),
            n.alias("n"),
        )
        for a, b in combinations(flags, 2)
    ]
    rows = counts.select(F.inline(F.array(*cells))).where("both > 0")
    forward, back = ratio(both, left), ratio(both, right)
    return rows.select(
        F.col("left").alias(f"left_{kind}"),
        F.col("right").alias(f"right_{kind}"),
        left.alias(f"left_{unit}"),
        right.alias(f"right_{unit}"),
        both.alias(f"both_{unit}"),
        (ratio(both, n) * 100.0).alias("support_pct"),
        (forward * 100.0).alias("left_to_right_conf_pct"),
        (back * 100.0).alias("right_to_left_conf_pct"),
        ratio(both.cast("double") * n.cast("double"), left.cast("double") * right.cast("double")).alias(
            "lift"
        ),
        ((forward + back) / 2.0 * 100.0).alias("kulczynski_pct"),
    )


def flag_rules(work: DataFrame) -> DataFrame:
    tests = [
        F.col("is_customer_missing"),
        F.col("is_description_missing"),
        F.col("is_damage"),
        F.col("is_cancellation"),
        F.col("is_bad_debt"),
        ~F.col("is_product_like"),
        F.col("price") == 0,
        F.col("quantity") < 0,
        F.col("is_gross_sale"),
    ]
    return _pair_rules(work, dict(zip(fv.LINE_FLAGS, tests, strict=True)), "flag", "rows")


def invoice_patterns(work: DataFrame, large: int = 50) -> DataFrame:
    """One row of flags per invoice; its country is the most frequent one, ties in name order."""
    countries = work.where(F.col("country").isNotNull()).groupBy("invoice", "country").agg(n_rows().alias("n"))
    main = countries.groupBy("invoice").agg(
        F.min(F.struct((-F.col("n")).alias("n"), "country"))["country"].alias("country")
    )
    levels = work.groupBy("invoice").agg(
        F.bool_and("is_customer_missing").alias("all_missing"),
        F.bool_or(F.upper("stock_code") == "DOT").alias("any_dot"),
        F.bool_or("is_damage").alias("any_damage"),
        F.bool_or(~F.col("is_product_like")).alias("any_non_product"),
        F.bool_or("is_bad_debt").alias("any_bad_debt"),
        F.count_distinct(F.when(F.col("is_gross_sale"), F.col("stock_code"))).alias("products"),
    )
    return levels.join(main, "invoice", "left").withColumn(
        "large_basket_50plus", F.col("products") >= large
    )


def invoice_pattern_rules(work: DataFrame) -> DataFrame:
    flags = {name: F.col(name) for name in fv.INVOICE_FLAGS}
    for label, country in fv.FLAGGED_COUNTRIES.items():
        flags[label] = F.col("country") == country
    return _pair_rules(invoice_patterns(work), flags, "pattern", "invoices")

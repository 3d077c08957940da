"""Sales facts, customer features, returns with the sale they undo, and output checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.numeric import count_where, money_sum, pct, whole_days_between
from ..functions.stock import is_product
from ..session import stored
from .retail import FACT_COLUMNS, fact_columns

MATCH_KEYS = ["buyer", "stock_code", "quantity_abs"]


def sales_facts(work: DataFrame) -> DataFrame:
    return fact_columns(work.where("is_gross_sale"))


def primary_country(facts: DataFrame) -> DataFrame:
    """Most frequent country per identified customer; ties go to the first name."""
    counts = (
        facts.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "country")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("country").isNull().alias("z"), "country"))
    return counts.groupBy("customer_id").agg(best["country"].alias("country"))


def customer_features(facts: DataFrame, lines: DataFrame) -> DataFrame:
    """Recency, frequency and money per identified customer.

    Recency counts whole 24-hour periods up to the latest of all lines, not only of the sales.
    """
    latest = lines.agg(F.max("invoice_datetime").alias("m")).scalar()
    known = facts.where(F.col("customer_id").isNotNull())
    per_customer = known.groupBy("customer_id").agg(
        F.count_distinct("invoice_no").alias("frequency"),
        money_sum(F.col("total_amount")).alias("monetary"),
        F.min("invoice_datetime").alias("first_purchase_date"),
        F.max("invoice_datetime").alias("last_purchase_date"),
        F.count_distinct("stock_code").alias("unique_products"),
    )
    return per_customer.join(primary_country(known), "customer_id", "left").select(
        "customer_id",
        whole_days_between(F.col("last_purchase_date"), latest).alias("recency_days"),
        "frequency",
        "monetary",
        "first_purchase_date",
        "last_purchase_date",
        "unique_products",
        "country",
        (F.col("frequency") == 1).alias("is_one_time_buyer"),
    )


def eligible_return() -> Column:
    return (
        (F.col("quantity") < 0)
        & (F.col("unit_price") > 0)
        & F.col("customer_id").isNotNull()
        & is_product(F.col("stock_code"))
    )


def match_returns(returns: DataFrame, facts: DataFrame) -> DataFrame:
    """Returns with ``matched_original_invoice``, the sale they undo; null where there is none.

    The sale has the same customer, code and absolute quantity and is the latest strictly before the
    return; of sales at one instant the greatest invoice counts; a sale may be matched many times.

    Sales and returns first shrink to the distinct instants of a key. The search then runs per key
    and calendar day, and one row per key and day carries the last sale over to later days, so no
    task ever holds the whole history of a key. Returns look their instant up; those that are not
    eligible carry a scattered key that fits nothing.
    """
    eligible = F.coalesce(eligible_return(), F.lit(False))
    nowhere = -1 - F.pmod(F.xxhash64(*FACT_COLUMNS), F.lit(1 << 40))
    left = returns.withColumns(
        {
            "quantity_abs": F.when(eligible, F.abs("quantity")).otherwise(nowhere),
            "at": F.col("invoice_datetime"),
            "buyer": F.coalesce("customer_id", F.lit("")),
        }
    )
    asked = returns.where(eligible).select(
        F.col("customer_id").alias("buyer"),
        "stock_code",
        F.abs("quantity").alias("quantity_abs"),
        F.col("invoice_datetime").alias("at"),
        F.lit(None).cast("string").alias("sale"),
        F.lit(True).alias("asked"),
    )
    sold = facts.where(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").alias("buyer"),
        "stock_code",
        F.abs("quantity").alias("quantity_abs"),
        F.col("invoice_datetime").alias("at"),
        F.col("invoice_no").alias("sale"),
        F.lit(False).alias("asked"),
    )
    instants = (
        asked.unionByName(sold)
        .groupBy(*MATCH_KEYS, "at")
        .agg(F.max("sale").alias("sale"), F.bool_or("asked").alias("asked"))
        .withColumn("day", F.to_date("at"))
        .dropna(subset=[*MATCH_KEYS, "at", "day"])
    )
    up_to_now = (Window.unboundedPreceding, -1)
    day = Window.partitionBy(*MATCH_KEYS, "day").orderBy("at")
    within = day.rowsBetween(*up_to_now)
    across = Window.partitionBy(*MATCH_KEYS).orderBy("day").rowsBetween(*up_to_now)
    # Written, since both searches below begin here. The last instant of a day carries what later days need.
    searched = stored(
        instants.select(
            *MATCH_KEYS,
            "day",
            "at",
            "asked",
            F.last("sale", ignorenulls=True).over(within).alias("recent"),
            F.when(F.lead("at").over(day).isNull(), F.struct(
                F.last("sale", ignorenulls=True).over(day.rowsBetween(Window.unboundedPreceding, 0)).alias("sale"),
                F.bool_or("asked").over(day.rowsBetween(Window.unboundedPreceding, 0)).alias("asked"),
            )).alias("end"),
        ).where(F.col("asked") | F.col("end").isNotNull()),
        "instants",
    )
    same_day = searched.where("asked").select(*MATCH_KEYS, "day", "at", "recent")
    carried = (
        searched.where("end is not null")
        .select(
            *MATCH_KEYS,
            "day",
            "end.asked",
            F.last("end.sale", ignorenulls=True).over(across).alias("earlier"),
        )
        .where("asked")
        .drop("asked")
    )
    matched = same_day.join(carried, [*MATCH_KEYS, "day"]).select(
        *MATCH_KEYS, "at", F.coalesce("recent", "earlier").alias("matched_original_invoice")
    )
    return left.join(matched, [*MATCH_KEYS, "at"], "left").select(
        *FACT_COLUMNS, "matched_original_invoice"
    )


def cancellations(work: DataFrame) -> DataFrame:
    return fact_columns(work.where("is_cancellation"))


def returns_log(work: DataFrame, facts: DataFrame) -> DataFrame:
    """All cancellation lines; the eligible ones carry the sale they undo, if there is one."""
    return match_returns(cancellations(work), facts)


def return_status(log: DataFrame) -> DataFrame:
    """Rows per outcome; the first outcome that fits counts."""
    matched = F.col("matched_original_invoice").isNotNull()
    product = is_product(F.col("stock_code"))
    status = (
        F.when(matched, fv.RETURN_MATCHED)
        .when(eligible_return(), fv.RETURN_UNMATCHED)
        .when(F.col("quantity") >= 0, fv.RETURN_NOT_NEGATIVE)
        .when(F.col("customer_id").isNull(), fv.RETURN_NO_CUSTOMER)
        .when(~product, fv.RETURN_NO_PRODUCT)
        .when(F.col("unit_price") <= 0, fv.RETURN_NO_PRICE)
        .otherwise(fv.RETURN_OTHER)
    )
    return log.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("rows"))


def unmatched_samples(log: DataFrame, limit: int = 10) -> DataFrame:
    """The first eligible returns without a sale; all columns settle ties."""
    order = ["invoice_datetime", "invoice_no", "stock_code"]
    rest = [c for c in FACT_COLUMNS if c not in order]
    return (
        log.where(eligible_return() & F.col("matched_original_invoice").isNull())
        .select(*FACT_COLUMNS)
        .orderBy(*order, *rest)
        .limit(limit)
    )


def long_counts(row: DataFrame, key: str, value: str) -> DataFrame:
    """Columns of a one-row frame as rows."""
    return row.unpivot([], row.columns, key, value)


def fact_totals(sales: DataFrame) -> DataFrame:
    """Totals of the sales lines as measures."""
    totals = sales.agg(
        money_sum(F.col("line_amount")).alias("sales_facts_total_amount"),
        F.sum("quantity").cast("double").alias("sales_facts_quantity_sum"),
    )
    return long_counts(totals, "measure", "amount")


def output_rules() -> dict[str, dict[str, Column]]:
    """What has to hold in every row, by table."""
    col = F.col
    return {
        "sales_facts": {
            "sale sells at least one piece": col("quantity") > 0,
            "sale has a price above zero": col("unit_price") > 0,
            "sale brings in money": col("total_amount") > 0,
            "sale is dated": col("invoice_datetime").isNotNull(),
        },
        "customer_features": {
            "feature row names its customer": col("customer_id").isNotNull(),
            "last purchase is not in the future": col("recency_days") >= 0,
            "customer bought once or more": col("frequency") >= 1,
            "customer spent no less than nothing": col("monetary") >= 0,
        },
        "returns_log": {
            "return comes from a cancellation": col("invoice_no").startswith("C"),
            "return undoes a sale, not a cancellation": col("matched_original_invoice").isNull()
            | ~col("matched_original_invoice").startswith("C"),
        },
    }


def _breaches(rules: dict[str, Column]) -> list[Column]:
    """How many rows break each rule. A rule holds only where it is true; missing values break it."""
    return [count_where(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]


def output_violations(facts: DataFrame, features: DataFrame, log: DataFrame) -> DataFrame:
    """Broken rules with their row counts: one pass per table, every rule present."""
    tables = (facts, features, log)
    counts = [long_counts(df.agg(*_breaches(rules)), "rule", "violations") for df, rules in zip(tables, output_rules().values(), strict=True)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def watched(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """The table and an observation that counts broken rules while the table is written.

    A task that is run again may count its rows again, so a count tells how bad it is only roughly; it is zero if and
    only if no row breaks the rule.
    """
    seen = Observation(f"rules of {table}")
    return df.observe(seen, *_breaches(output_rules()[table])), seen


def observed_violations(spark: SparkSession, seen: dict[str, Observation], written: dict[str, DataFrame]) -> DataFrame:
    """``rule, violations`` out of the observations of written tables, every rule present.

    A table without rows breaks no rule; adaptive execution may drop its plan together with the observation.
    """
    counts = {table: {} if written[table].isEmpty() else seen[table].get for table in seen}
    rows = [(rule, int(counts[table].get(rule, 0))) for table, rules in output_rules().items() for rule in rules]
    return spark.createDataFrame(rows, "rule string, violations long")


def require_columns(df: DataFrame, columns: list[str], name: str) -> None:
    if df.columns != columns:
        raise ValueError(f"{name} schema mismatch: {df.columns}")


def require_no_violations(violations: DataFrame) -> None:
    """The rule table is a dozen rows, whatever the data holds."""
    found = [f"{r['rule']}: {r['violations']}" for r in violations.where("violations > 0").collect()]
    if found:
        raise ValueError("; ".join(found))


def etl_summary(work: DataFrame, facts: DataFrame, log: DataFrame) -> DataFrame:
    """Row counts and the match rate; there is one feature row per identified customer of the facts."""
    eligible = eligible_return()
    matched = eligible & F.col("matched_original_invoice").isNotNull()
    rows = F.count(F.lit(1)).cast("double")
    logged = log.agg(
        rows.alias("returns_log_rows"),
        count_where(eligible).cast("double").alias("eligible_return_rows"),
        count_where(matched).cast("double").alias("matched_eligible_returns"),
        F.coalesce(pct(count_where(matched), count_where(eligible)), F.lit(0.0)).alias(
            "eligible_return_match_rate_pct"
        ),
    )
    parts = [
        work.agg(rows.alias("input_rows")),
        facts.agg(
            rows.alias("sales_facts_rows"),
            F.count_distinct("customer_id").cast("double").alias("customer_features_rows"),
        ),
        logged,
    ]
    out = long_counts(parts[0], "metric", "value")
    for part in parts[1:]:
        out = out.unionByName(long_counts(part, "metric", "value"))
    return out

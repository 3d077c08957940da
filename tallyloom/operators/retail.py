"""Meaning of retail lines: flags, fact columns and customer ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stock import is_product, stock_category
from ..functions.text import strip_space

FACT_COLUMNS = [
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "unit_price",
    "total_amount",
    "invoice_datetime",
    "customer_id",
    "country",
]


def known(condition: Column, *inputs: Column) -> Column:
    """A flag that is false where an input is missing.

    It stays a plain conjunction, so a filter on it reaches the scan part by part.
    """
    for c in inputs:
        condition = c.isNotNull() & condition
    return condition


def retail_work(lines: DataFrame) -> DataFrame:
    """Retail lines with amount, prefix, category and flags.

    The flags test codes and invoices directly, so a filter on a flag costs one pattern match.
    """
    invoice, quantity, price = F.col("invoice"), F.col("quantity"), F.col("price")
    base = lines.select(
        F.col("Invoice").cast("string").alias("invoice"),
        strip_space(F.col("StockCode")).alias("stock_code"),
        F.col("Description").alias("description"),
        F.col("Quantity").cast("bigint").alias("quantity"),
        F.col("InvoiceDate").cast("timestamp_ntz").alias("invoice_datetime"),
        F.col("Price").cast("double").alias("price"),
        F.col("Customer ID").alias("customer_id_raw"),
        F.col("Country").alias("country"),
    )
    letters = F.nullif(F.regexp_extract(invoice, "^([A-Za-z]+)", 1), F.lit(""))
    cancelled, bad_debt = invoice.startswith("C"), invoice.startswith("A")
    code = F.col("stock_code")
    numbered = ~invoice.rlike("^[A-Za-z]")
    given = (invoice, quantity, price)
    return base.withColumns(
        {
            "line_amount": quantity * price,
            "invoice_prefix": F.coalesce(letters, F.lit("numeric")),
            "stock_category": stock_category(F.col("stock_code")),
            "is_cancellation": known(cancelled, invoice),
            "is_bad_debt": known(bad_debt, invoice),
            "customer_id": normalize_customer_id(F.col("customer_id_raw")),
            "is_customer_missing": F.col("customer_id_raw").isNull(),
            "is_description_missing": F.col("description").isNull(),
            "is_damage": known((price == 0) & (quantity < 0) & ~cancelled & ~bad_debt, *given),
            "is_product_like": known(is_product(code), code),
            "is_gross_sale": known(
                (quantity > 0) & (price > 0) & numbered & is_product(code), *given, code
            ),
            "is_net_line": known(
                (price > 0) & (quantity != 0) & ~bad_debt & is_product(code), *given, code
            ),
        }
    )


def normalize_customer_id(raw: Column) -> Column:
    """``13085.0`` becomes ``13085``; ids that are not whole numbers stay as trimmed text."""
    text = strip_space(raw.cast("string"))
    number = text.try_cast("decimal(38,10)")
    whole = number.isNotNull() & (number == F.floor(number))
    return F.when(whole, number.cast("decimal(38,0)").cast("string")).otherwise(text)


def fact_columns(work: DataFrame) -> DataFrame:
    return work.select(
        F.col("invoice").alias("invoice_no"),
        "stock_code",
        "description",
        "quantity",
        F.col("price").alias("unit_price"),
        F.col("line_amount").alias("total_amount"),
        "invoice_datetime",
        "customer_id",
        "country",
    )


def fact_order() -> list[Column]:
    """Reading order of facts: missing customers last."""
    return [
        F.col("invoice_datetime").asc_nulls_last(),
        F.col("invoice_no").asc_nulls_last(),
        F.col("stock_code").asc_nulls_last(),
        F.col("customer_id").asc_nulls_last(),
    ]

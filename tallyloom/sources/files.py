"""Typed readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv
from ..operators.retail import fact_order

WITH_LINE_BREAKS = ("order_reviews",)
BOM = "﻿"


def conform_retail(raw: DataFrame) -> DataFrame:
    """Rename known aliases, insist on the eight canonical columns and keep only those, typed."""
    renamed = raw.withColumnsRenamed(
        {old: new for old, new in fv.RETAIL_ALIASES.items() if old in raw.columns}
    )
    missing = [c for c in fv.RETAIL_COLUMNS if c not in renamed.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return renamed.select(
        [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schemas.RETAIL]
    )


def _read_csv(spark: SparkSession, path: str, line_breaks: bool) -> DataFrame:
    """Text columns by header. A file is split over tasks unless cells may hold line breaks."""
    raw = spark.read.option("header", True).option("multiLine", line_breaks).option("escape", '"').csv(path)
    return raw.withColumnsRenamed({c: c.removeprefix(BOM) for c in raw.columns})


def read_retail(
    spark: SparkSession, path: str, file_format: str = "parquet", line_breaks: bool = False
) -> DataFrame:
    """Retail lines from parquet or CSV. CSV columns arrive as text and are cast by name."""
    if file_format == "csv":
        raw = _read_csv(spark, path, line_breaks)
    else:
        raw = spark.read.format(file_format).load(path)
    return conform_retail(raw)


def read_marketplace(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The marketplace CSV tables, typed. Text cells may hold quotes; only reviews hold line breaks.

    Columns are matched by header name, so the reader sees the header first; nothing is inferred
    from the data.
    """
    tables = {}
    for name, path in paths.items():
        schema = schemas.MARKETPLACE[name]
        raw = _read_csv(spark, path, line_breaks=name in WITH_LINE_BREAKS)
        missing = [f.name for f in schema if f.name not in raw.columns]
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
        tables[name] = raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return tables


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    # Outer blanks are part of a cell.
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, escape='"', compression=compression, **keep).csv(path)


def write_sales_facts(facts: DataFrame, path: str) -> None:
    """One folder per sale date, rows inside a file in reading order.

    Rows are rebalanced by date: adaptive execution splits a busy date over several writers and lets
    quiet dates share one.
    """
    (
        facts.withColumn("sale_date", F.to_date("invoice_datetime"))
        .hint("rebalance", F.col("sale_date"))
        .sortWithinPartitions("sale_date", *fact_order())
        .write.mode("overwrite")
        .partitionBy("sale_date")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_review_results(records: DataFrame, metadata: DataFrame, path: str) -> None:
    """Records as JSON lines with a one-row run description beside them."""
    records.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/records")
    metadata.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/metadata")


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a known schema. A line that is no JSON, or holds a value of another type, comes with ``_broken``."""
    fields = f"{schema}, _broken string"
    return spark.read.schema(fields).options(mode="PERMISSIVE", columnNameOfCorruptRecord="_broken").json(path)


def read_review_results(spark: SparkSession, path: str) -> DataFrame:
    """Written review records, and ``defect``: what is wrong with a line, null for a sound one."""
    rows = _json(spark, f"{path}/records", schemas.REVIEW_RESULT)
    kinds = [f"{c}.{s}" for c, subs in fv.TAXONOMY.items() for s in subs]
    known = F.forall("issues", lambda i: F.concat(i["category"], F.lit("."), i["subcategory"]).isin(kinds))
    sure = F.forall("issues", lambda i: i["confidence"].between(0, 1) & i["evidence"].isNotNull())
    needed = [c.split()[0] for c in ("review_id", "review_score", "raw_text", "normalized_text_hash", "method", "needs_manual_review", "actionable_for_seller")]
    defect = (
        F.when(F.col("_broken").isNotNull(), "not readable")
        .when(F.greatest(*[F.col(c).isNull().cast("int") for c in needed]) == 1, "missing field")
        .when(F.coalesce(F.size("issues"), F.lit(0)) < 1, "no issue")
        .when(~F.coalesce(known, F.lit(False)), "unknown kind of issue")
        .when(~F.coalesce(sure, F.lit(False)), "evidence or confidence out of range")
    )
    return rows.withColumn("defect", defect).drop("_broken")


def read_run_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The one-row description of a written run; a broken file is refused."""
    rows = _json(spark, f"{path}/metadata", schemas.RUN_METADATA)
    # A run has one line.
    found = rows.limit(2).collect()
    if len(found) != 1 or found[0]["_broken"] is not None:
        raise ValueError(f"{path}/metadata does not describe one run")
    return rows.drop("_broken")


def require_sound_results(results: DataFrame) -> None:
    """Refuse results with defective lines; the message counts them by defect."""
    found = results.where("defect is not null").groupBy("defect").agg(F.count(F.lit(1)).alias("n")).orderBy("defect").collect()
    if found:
        raise ValueError("; ".join(f"{r['defect']}: {r['n']}" for r in found))

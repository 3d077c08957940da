"""Retail ETL: three tables out of retail lines, checked before they are published."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import etl
from ..operators.retail import FACT_COLUMNS, retail_work
from ..session import stored
from ..sources.files import write_sales_facts, write_table

FEATURE_COLUMNS = [
    "customer_id",
    "recency_days",
    "frequency",
    "monetary",
    "first_purchase_date",
    "last_purchase_date",
    "unique_products",
    "country",
    "is_one_time_buyer",
]


@dataclass(frozen=True)
class EtlTables:
    work: DataFrame
    sales_facts: DataFrame
    customer_features: DataFrame
    returns_log: DataFrame


def build_tables(lines: DataFrame) -> EtlTables:
    """The classified lines are written once; all three outputs read them back."""
    work = stored(retail_work(lines), "work")
    facts = etl.sales_facts(work)
    return EtlTables(
        work, facts, etl.customer_features(facts, work), etl.returns_log(work, facts)
    )


def run(lines: DataFrame, path: str) -> DataFrame:
    """Write the three outputs into a new version below ``path`` and return the summary rows.

    The rules are counted while the tables are written, without another scan, and the counts lie beside
    them; only a version that passes is published, by one last small file. Readers follow that file, so they never see
    tables of two versions.
    """
    spark = lines.sparkSession
    tables = build_tables(lines)
    etl.require_columns(tables.sales_facts, FACT_COLUMNS, "sales_facts")
    etl.require_columns(tables.customer_features, FEATURE_COLUMNS, "customer_features")
    etl.require_columns(
        tables.returns_log, [*FACT_COLUMNS, "matched_original_invoice"], "returns_log"
    )
    version = f"version-{uuid.uuid4().hex}"
    writers = {"sales_facts": write_sales_facts, "customer_features": write_table, "returns_log": write_table}
    fields = [(name, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in getattr(tables, name).schema)) for name in writers]
    spark.createDataFrame(fields, "table string, fields string").coalesce(1).write.json(f"{path}/{version}/schemas")
    seen = {}
    for name, write in writers.items():
        table, seen[name] = etl.watched(getattr(tables, name), name)
        write(table, f"{path}/{version}/{name}")
    written = _tables(spark, f"{path}/{version}")
    violations = etl.observed_violations(spark, seen, written)
    violations.coalesce(1).write.json(f"{path}/{version}/checks")
    etl.require_no_violations(violations)
    mark = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    mark.coalesce(1).write.mode("append").json(f"{path}/published")
    return etl.etl_summary(tables.work, written["sales_facts"], written["returns_log"])


def _tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The named tables of a version, all if none is named, by the fields that lie beside them: a table without rows may
    have no file to tell. Opening the facts lists a folder per sale date, so they are opened only where they are asked for."""
    columns = {"sales_facts": FACT_COLUMNS, "customer_features": FEATURE_COLUMNS, "returns_log": [*FACT_COLUMNS, "matched_original_invoice"]}
    # One row per table.
    fields = {r["table"]: r["fields"] for r in spark.read.schema("table string, fields string").json(f"{folder}/schemas").collect()}
    return {name: spark.read.schema(fields[name]).parquet(f"{folder}/{name}").select(*columns[name]) for name in names or columns}


def _published_version(spark: SparkSession, path: str) -> str:
    marks = spark.read.schema("version string, published_at timestamp").json(f"{path}/published")
    return marks.orderBy(F.desc("published_at"), F.desc("version")).first()["version"]


def read_published(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    """The named tables, all if none is named, of the version that was published last."""
    return _tables(spark, f"{path}/{_published_version(spark, path)}", *names)


def read_checks(spark: SparkSession, path: str) -> DataFrame:
    """``rule, violations`` as they were counted while that version was written."""
    return spark.read.schema("rule string, violations long").json(f"{path}/{_published_version(spark, path)}/checks")

"""Quantiles from sketches of single days, beside the exact way of ``quantiles``.

A day is summed up in one KLL sketch per group, a few kilobytes whatever the day holds. Sketches merge, so quantiles over any
days come from sketches alone, and a new or corrected day is the only one that is read again. The rank of an
answer is off by at most ``rank_error`` of all values, in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 2000  # values kept at most on a level of a sketch


def rank_error(size: int = SIZE) -> float:
    """Error of a rank as a share of all values, not exceeded with 99% confidence; the published fit for KLL sketches."""
    return 2.296 / size**0.9723


def day_sketches(df: DataFrame, day: str, values: Sequence[str], groups: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """``day, groups..., measure, n, sketch``: one row per day, group and measure; missing values and NaN are left out."""
    measures = F.array(*[F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value")) for v in values])
    long = df.select(F.to_date(day).alias("day"), *groups, F.explode(measures).alias("m")).select("day", *groups, "m.*")
    known = long.where("value is not null and not isnan(value)")
    return known.groupBy("day", *groups, "measure").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch"))


def write_day_sketches(sketches: DataFrame, path: str) -> None:
    """Write or replace the days that ``sketches`` holds; other days stay as they are."""
    rows = sketches.hint("rebalance", F.col("day"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def read_day_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float], groups: Sequence[str] = ()) -> DataFrame:
    """``groups..., measure, p, quantile, n`` over all days of ``sketches``, a value of the data each.

    Without sketches there is no row.
    """
    whole = sketches.groupBy(*groups, "measure").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs])
    return whole.select(*groups, "measure", "n", F.explode(wanted).alias("q")).select(*groups, "measure", "q.*", "n")


def true_ranks(df: DataFrame, found: DataFrame, values: Sequence[str]) -> DataFrame:
    """``measure, p, quantile, n, below, upto``: the shares of values below and up to each answer, counted exactly.

    ``found`` has a row for each measure and probability, as many as the caller asked for, and is broadcast.
    """
    measures = F.array(*[F.struct(F.lit(v).alias("measure"), F.col(v).cast("double").alias("value")) for v in values])
    long = df.select(F.explode(measures).alias("m")).select("m.*").where("value is not null and not isnan(value)")
    counts = long.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("c"))
    each = counts.join(F.broadcast(found), "measure").groupBy("measure", "p", "quantile", "n")
    less, not_more = F.col("value") < F.col("quantile"), F.col("value") <= F.col("quantile")
    share = [(F.sum(F.when(w, F.col("c")).otherwise(0)) / F.sum("c")).alias(name) for w, name in ((less, "below"), (not_more, "upto"))]
    return each.agg(*share)

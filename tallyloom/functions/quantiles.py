"""Exact quantiles without sorting everything in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored


def magnitude_bucket(value: Column) -> Column:
    """A whole number that never decreases with ``value``: about 1% wide steps on a signed log scale.

    A double has fewer than 300,000 such steps, whatever the data holds.
    """
    step = F.floor(F.log2(F.abs(value)) * 64.0) + 70000
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * step).cast("int")


FINE = 1 << 16


def _fine_buckets(value: Column, bucket: Column) -> tuple[Column, Column]:
    """Two further steps within a magnitude bucket, each 1/65536 of the one before; they rise with ``value``.

    Values that agree in all three steps differ in fewer than 2**15 bits patterns, whatever the data holds.
    """
    low = F.pow(F.lit(2.0), (F.abs(bucket) - 70000) / 64.0)
    place = (F.abs(value) / low - 1.0) * (FINE * 90.0)
    first = F.floor(place)
    second = F.floor((place - first) * FINE)
    sign = F.when(value < 0, -1).otherwise(1)
    flat = F.lit(0).cast("bigint")
    return F.when(value == 0, flat).otherwise(sign * first), F.when(value == 0, flat).otherwise(sign * second)


def _narrow(hist: DataFrame, targets: DataFrame, keys: Sequence[str], step: str) -> DataFrame:
    """Move every target into the part ``step`` of its bucket that holds its rank.

    ``targets``: keys, p, side, frac, n and ``_rank`` within the bucket. Only counts per part are compared;
    a bucket has a bounded number of parts.
    """
    wanted = targets.select(*keys).distinct()
    counts = hist.join(F.broadcast(wanted), list(keys)).groupBy(*keys, step).agg(F.sum("_n").alias("_count"))
    before = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.withColumn("_start", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    # A handful of targets per group meets the parts of its bucket.
    placed = parts.join(F.broadcast(targets), list(keys)).where("_rank >= _start and _rank < _start + _count")
    return placed.withColumn("_rank", F.col("_rank") - F.col("_start")).drop("_start", "_count")


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolated quantiles as rows ``groups..., p, quantile, n``.

    Equal values are counted first, so a heavy value is one row. Each wanted rank is then narrowed down by
    counts alone, through buckets of about 1% and two steps of 1/65536; the few values that share all
    three are put in order, and no task sorts more than those. Groups must be few; the values per group
    may be any number.
    """
    g = list(groups)
    hist = (
        df.where(F.col(value).isNotNull())
        .groupBy(*g, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_b0", magnitude_bucket(F.col("_v")))
    )
    first, second = _fine_buckets(F.col("_v"), F.col("_b0"))
    # Read once for the sizes and once for each step, so it is counted once and written out.
    hist = stored(hist.withColumns({"_b1": first, "_b2": second}), "value-counts")
    sizes = hist.groupBy(*g).agg(F.sum("_n").alias("n"))
    targets = []
    for p in probs:
        position = (F.col("n") - 1) * F.lit(float(p))
        for side, rank in ((0, F.floor(position)), (1, F.ceil(position))):
            targets.append(
                F.struct(
                    F.lit(float(p)).alias("p"),
                    F.lit(side).alias("side"),
                    (position - F.floor(position)).alias("frac"),
                    rank.cast("bigint").alias("_rank"),
                )
            )
    # One constant key, so that frames without groups take the same way.
    hist = hist.withColumn("_all", F.lit(0))
    keys = [*g, "_all"]
    at = sizes.select(*g, F.lit(0).alias("_all"), "n", F.explode(F.array(*targets)).alias("t")).select(*keys, "n", "t.*")
    for step in ("_b0", "_b1", "_b2"):
        at = _narrow(hist, at, keys, step)
        keys = [*keys, step]
    at = _narrow(hist, at, keys, "_v")
    low = F.max(F.when(F.col("side") == 0, F.col("_v")))
    high = F.max(F.when(F.col("side") == 1, F.col("_v")))
    return at.groupBy(*g, "p").agg((low + (high - low) * F.max("frac")).alias("quantile"), F.max("n").alias("n"))


def quantile_columns(
    df: DataFrame, value: str, names: dict[str, float], groups: Sequence[str] = ()
) -> DataFrame:
    """The same quantiles as one row per group, one named column per probability."""
    rows = exact_quantiles(df, value, sorted(set(names.values())), groups)
    cells = [
        F.max(F.when(F.col("p") == float(p), F.col("quantile"))).alias(name)
        for name, p in names.items()
    ]
    return rows.groupBy(*groups).agg(*cells) if groups else rows.agg(*cells)

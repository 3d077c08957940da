"""Running totals over a global order, in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hex_block(key: Column, digits: int = 4) -> Column:
    """Contiguous range of a hex-digest order: its leading digits, at most 16**digits ranges."""
    return F.substring(key, 1, digits)


def running_total(
    df: DataFrame, blocks: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add the inclusive running sum of ``value`` in the order ``blocks + order``.

    ``blocks`` must be a leading part of the order with a bounded number of values. Rows are summed
    per block in parallel; only the block totals, a bounded table, are scanned in one place.
    """
    earlier = Window.orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*blocks)
        .agg(F.sum(value).alias("_total"))
        .select(*blocks, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy(*blocks)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        df.join(F.broadcast(offsets), list(blocks))
        .withColumn(name, F.sum(value).over(inside) + F.col("_offset"))
        .drop("_offset")
    )

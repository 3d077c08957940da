"""Daily reconciliation as a job: totals of the source and of what is served, joined as their days come in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import marketplace as mk
from .orders import UP_TO_NOW, _run

WAIT = "7 days"  # so long, in days of the totals, a day waits for the other side


def reconcile_job(source: DataFrame, served: DataFrame, path: str, checkpoint: str, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    """Append one row per day: the differences between two streams of ``mk.day_totals``.

    Each side sends a day once, in about the order of days. A day that both sides have sent is written at once. One
    that a side lacks is written when both sides are WAIT beyond it, the lacking side counting as zero; a total that comes
    later still is not taken. So the state holds the days of that span only, and the newest unpaired days wait for newer ones.
    """
    sides = [s.withColumn("day", F.col("day").cast("timestamp")).withWatermark("day", WAIT) for s in (source, served)]
    return _run(mk.reconcile(*sides).writeStream.format("parquet").option("path", path), checkpoint, trigger)

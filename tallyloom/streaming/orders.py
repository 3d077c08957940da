"""Order event streams: parsed events, dead letters, current status, seller days and late alerts.

Every readable event lands in a log, whenever it arrives, through the engine's own file sink, whose list of
committed files keeps a repeated micro-batch from showing twice. A second log takes each event once as long as it
comes within LATENESS of the newest one; the engine's keyed state knows the ids of that span and forgets them
behind the watermark, so the state does not grow with the stream. What is in the first log only came too late, and its
share is added where figures are read. Other sinks write micro-batch N to its own folder ``batch_id=N`` and
overwrite it when the batch is tried again, so a lost executor or driver leaves no trace. Each job has a
batch twin over the same rows; the stream's final state equals it.

Jobs run to the end of what is there unless they are given another trigger, such as
``{"processingTime": "30 seconds"}``; then they return the running query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import money_sum, n_rows

PAYLOAD = (
    "order_id string, seller_id string, status string, version bigint, "
    "estimated_delivery_date timestamp, amount decimal(12,2), _broken string"
)
LOG = (
    "event_id string, event_time timestamp, order_id string, seller_id string, status string, "
    "version bigint, estimated_delivery_date timestamp, amount decimal(12,2)"
)
LATENESS = "2 days"  # an event that much older than the newest one of earlier micro-batches is late
UP_TO_NOW = {"availableNow": True}
CLOSED = ["delivered", "canceled"]

Sink = Callable[[DataFrame, int], None]


# --- events ----------------------------------------------------------------------------------


def parsed_events(events: DataFrame) -> DataFrame:
    """``event_id, event_time, payload`` with the payload's fields and a ``readable`` flag."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    read = events.withColumn("p", F.from_json("payload", PAYLOAD, options))
    readable = F.col("p._broken").isNull()
    for name in ("order_id", "status", "version"):
        readable = readable & F.col(f"p.{name}").isNotNull()
    return read.select(
        "event_id",
        "event_time",
        "payload",
        F.coalesce(readable, F.lit(False)).alias("readable"),
        *[F.col(f"p.{c}").alias(c) for c in ("order_id", "seller_id", "status", "version", "estimated_delivery_date", "amount")],
    )


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where("readable").drop("payload", "readable")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where("not readable").select("event_id", "event_time", "payload")


def distinct_events(good: DataFrame) -> DataFrame:
    """Each event once; copies of an event are alike."""
    return good.dropDuplicates(["event_id"])


# --- batch twins -----------------------------------------------------------------------------


def latest_status(events: DataFrame) -> DataFrame:
    """The state with the highest version per order, whatever the order of arrival."""
    state = F.struct("status", "version", "event_time", "seller_id", "estimated_delivery_date")
    return (
        events.groupBy("order_id")
        .agg(F.max_by(state, F.struct("version", "event_time", "event_id")).alias("s"))
        .select("order_id", "s.*")
    )


def seller_daily(events: DataFrame) -> DataFrame:
    """Events, sales and amount per seller and day of event time."""
    sold = F.col("status") == "delivered"
    return events.groupBy(F.window("event_time", "1 day").alias("w"), "seller_id").agg(
        n_rows().alias("events"),
        F.count(F.when(sold, 1)).alias("sales"),
        F.sum(F.when(sold, F.col("amount")).otherwise(F.lit(0).cast("decimal(12,2)")))
        .cast("decimal(22,2)")
        .alias("amount"),
    ).select(F.col("w.start").alias("day"), "seller_id", "events", "sales", "amount")


def monthly_curve(daily: DataFrame, months: int = 6) -> DataFrame:
    """Sales per seller and month over the last months in the table."""
    last = daily.agg(F.max("day").alias("d")).scalar()
    month = F.date_format("day", "yyyy-MM")
    start = F.add_months(F.trunc(last, "month"), -(months - 1))
    return (
        daily.where(F.to_date("day") >= start)
        .groupBy("seller_id", month.alias("month"))
        .agg(F.sum("sales").alias("sales"), money_sum(F.col("amount")).alias("amount"))
    )


def order_progress(events: DataFrame, *more: Column) -> DataFrame:
    """What lateness depends on, per order."""
    closing = F.col("status").isin(CLOSED)
    return events.groupBy("order_id").agg(
        F.max_by("estimated_delivery_date", "version").alias("due"),
        F.min(F.when(closing, F.col("event_time"))).alias("closed_at"),
        F.max_by("seller_id", "version").alias("seller_id"),
        F.max("version").alias("version"),
        *more,
    )


def _overdue(now: Column) -> Column:
    return (F.col("due") < now) & F.col("closed_at").isNull()


def late_alerts(events: DataFrame) -> DataFrame:
    """Orders past their estimate and still open at the latest event time, once each."""
    now = events.agg(F.max("event_time").alias("t")).scalar()
    return order_progress(events).where(_overdue(now)).select("order_id", "seller_id", "due")


# --- streaming jobs --------------------------------------------------------------------------


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def _put(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(_batch_folder(path, batch_id))


def overwrite_sink(path: str) -> Sink:
    """Micro-batch N in a folder of its own, which a repeated N replaces."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        _put(batch, path, batch_id)

    return sink


def _run(writer, checkpoint: str, trigger: dict) -> StreamingQuery:
    query = writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    if trigger == UP_TO_NOW:
        query.awaitTermination()
    return query


def run_batches(stream: DataFrame, checkpoint: str, sink: Sink, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    """Hand every micro-batch to ``sink``."""
    return _run(stream.writeStream.foreachBatch(sink), checkpoint, trigger)


def split_sink(good_path: str, dead_path: str) -> Sink:
    """Readable events to one table, the others to the dead letters."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        _put(good_events(batch), good_path, batch_id)
        _put(dead_letters(batch), dead_path, batch_id)
        batch.unpersist()

    return sink


def split_job(events: DataFrame, folder: str, checkpoint: str, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    sink = split_sink(f"{folder}/good", f"{folder}/dead")
    return run_batches(parsed_events(events), checkpoint, sink, trigger)


def log_job(events: DataFrame, path: str, checkpoint: str, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    """Append every readable event to the log, by day of event time."""
    rows = good_events(parsed_events(events)).withColumn("event_date", F.to_date("event_time"))
    return _run(rows.writeStream.format("parquet").option("path", path).partitionBy("event_date"), checkpoint, trigger)


def log_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The log as a stream of its committed files, at most so many in a micro-batch."""
    reader = spark.readStream.schema(f"{LOG}, event_date date")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def on_time(good: DataFrame) -> DataFrame:
    """Each event once, if it is not late: copies and late events are left out by the engine's keyed state.

    A copy has the time of its event. So when an id is forgotten, the watermark has passed its time, and a later copy
    is late itself.
    """
    return good.withWatermark("event_time", LATENESS).dropDuplicatesWithinWatermark(["event_id"])


def accepted_job(events: DataFrame, path: str, checkpoint: str, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    """Append every event that is on time to a second log, once, by day of event time."""
    rows = on_time(good_events(parsed_events(events))).withColumn("event_date", F.to_date("event_time"))
    return _run(rows.writeStream.format("parquet").option("path", path).partitionBy("event_date"), checkpoint, trigger)


def log_table(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows of a log."""
    return spark.read.schema(f"{LOG}, event_date date").parquet(path)


def late_events(log: DataFrame, accepted: DataFrame) -> DataFrame:
    """The events of the log, once each, that came too late to be accepted. Days meet days only."""
    known = accepted.select("event_date", "event_id")
    return distinct_events(log.join(known, ["event_date", "event_id"], "left_anti"))


def status_job(log: DataFrame, path: str, checkpoint: str, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    """Keep the current status of every order in the engine's state; a micro-batch writes the orders that changed.

    The highest version wins, so copies, late events and the order of arrival make no difference.
    """
    return _run(_newest(log).writeStream.outputMode("update").foreachBatch(overwrite_sink(path)), checkpoint, trigger)


def _newest(rows: DataFrame) -> DataFrame:
    """The event that decides an order's state."""
    whole = F.struct("order_id", "status", "version", "event_time", "event_id", "seller_id", "estimated_delivery_date")
    best = F.max_by(whole, F.struct("version", "event_time", "event_id")).alias("s")
    return rows.groupBy("order_id").agg(best).select("s.*")


def current_status(spark: SparkSession, path: str) -> DataFrame:
    return latest_status(spark.read.parquet(path).drop("batch_id"))


def seller_daily_job(accepted: DataFrame, path: str, checkpoint: str, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    """Windows of a day and seller in the engine's state, which lets a day go once the watermark has passed it.

    ``accepted`` follows the log of accepted events by whole commits (no limit of files in a micro-batch): then nothing
    in it is late here. A micro-batch writes the new figures of the groups that it touches, no others.
    """
    figures = seller_daily(accepted.withWatermark("event_time", LATENESS))
    return _run(figures.writeStream.outputMode("update").foreachBatch(overwrite_sink(path)), checkpoint, trigger)


def current_seller_days(spark: SparkSession, path: str, late: DataFrame) -> DataFrame:
    """The last figures of each group, and the share of the late events."""
    rows = spark.read.parquet(path)
    last = rows.groupBy("day", "seller_id").agg(F.max_by(F.struct("events", "sales", "amount"), "batch_id").alias("f")).select("day", "seller_id", "f.*")
    both = last.unionByName(seller_daily(late).select(last.columns))
    return both.groupBy("day", "seller_id").agg(
        F.sum("events").alias("events"), F.sum("sales").alias("sales"), F.sum("amount").cast("decimal(22,2)").alias("amount")
    )


def progress_job(events: DataFrame, path: str, checkpoint: str, trigger: dict = UP_TO_NOW) -> StreamingQuery:
    """Keep what lateness depends on, one row per order, in the engine's state; a micro-batch writes the orders it touches.

    Nothing is forgotten, so a late or repeated event of a closed order changes nothing, however old the order is.
    """
    clean = good_events(parsed_events(events))
    figures = order_progress(clean, F.max("event_time").alias("clock"))
    return _run(figures.writeStream.outputMode("update").foreachBatch(overwrite_sink(path)), checkpoint, trigger)


def current_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The overdue orders, once each, by the last progress of every order. The clock is the latest event time of all:
    an order that hears nothing more becomes overdue by the events of others."""
    rows = spark.read.parquet(path)
    now = rows.agg(F.max("clock").alias("t")).scalar()
    last = rows.groupBy("order_id").agg(F.max_by(F.struct("due", "closed_at", "seller_id"), "batch_id").alias("p"))
    return last.select("order_id", "p.*").where(_overdue(now)).select("order_id", "seller_id", "due")

from datetime import datetime, timedelta

import json
from decimal import Decimal
import pytest
from pyspark.sql import functions as F

from tallyloom.session import fresh_folder
from tallyloom.streaming import orders as so, reviews as sr

T0 = datetime(2024, 1, 10)
RAW = "event_id string, event_time timestamp, payload string"


def event(n, order, status, version, hours, due_hours=1000, amount=10.0):
    payload = {
        "order_id": order, "seller_id": "s1", "status": status, "version": version,
        "estimated_delivery_date": str(T0 + timedelta(hours=due_hours)), "amount": amount,
    }
    return (f"e{n}", T0 + timedelta(hours=hours), json.dumps(payload))


@pytest.fixture()
def feed(spark):
    """Write micro-batches as files; the stream reads one file at a time in order."""

    def write(*batches, schema=RAW):
        folder = fresh_folder(spark, "feed")
        for n, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={n}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False)
        return stream.parquet(f"{folder}/part=*"), spark.read.schema(schema).parquet(f"{folder}/part=*"), folder

    return write


def test_latest_status_is_independent_of_arrival(spark, feed):
    first = [event(1, "a", "created", 1, 0), event(2, "a", "shipped", 3, 2), event(9, "b", "created", 1, 1)]
    second = [event(3, "a", "paid", 2, 1), event(2, "a", "shipped", 3, 2), ("bad", T0, "{oops"), event(4, "b", "canceled", 2, 3)]
    # Nine days behind the newest event, the last word on order c.
    third, fourth = [event(5, "c", "shipped", 1, 240)], [event(6, "c", "delivered", 2, 24)]
    stream, batch, folder = feed(first, second, third, fourth)
    so.log_job(stream, f"{folder}-log", f"{folder}-cp")
    assert spark.read.parquet(f"{folder}-log").count() == 8
    want = {("a", "shipped", 3), ("b", "canceled", 2), ("c", "delivered", 2)}
    so.status_job(so.log_stream(spark, f"{folder}-log"), f"{folder}-status", f"{folder}-cp1")
    got = {(r.order_id, r.status, r.version) for r in so.current_status(spark, f"{folder}-status").collect()}
    assert got == want
    twin = so.latest_status(so.distinct_events(so.good_events(so.parsed_events(batch))))
    assert {(r.order_id, r.status, r.version) for r in twin.collect()} == want


def test_a_batch_writes_the_orders_that_changed(spark, feed):
    """The state knows earlier versions: a batch that brings an old one writes what holds now."""
    batches = [[event(1, "a", "paid", 2, 1), event(2, "b", "paid", 1, 1)], [event(3, "a", "created", 1, 0)], [event(4, "c", "paid", 1, 2), event(1, "a", "paid", 2, 1)]]
    stream, _, folder = feed(*batches)
    good = so.good_events(so.parsed_events(stream))
    so.status_job(good, f"{folder}-status", f"{folder}-cp")
    changes = spark.read.parquet(f"{folder}-status")
    assert sorted((r.batch_id, r.order_id, r.version) for r in changes.collect()) == [(0, "a", 2), (0, "b", 1), (1, "a", 2), (2, "a", 2), (2, "c", 1)]
    assert sorted((r.order_id, r.status) for r in so.current_status(spark, f"{folder}-status").collect()) == [("a", "paid"), ("b", "paid"), ("c", "paid")]


def logs(spark, folder):
    return so.log_table(spark, f"{folder}-log"), so.log_table(spark, f"{folder}-accepted")


def run_days(spark, folder, stream):
    """All jobs behind the sales of a day, up to what is there, and their figures."""
    so.log_job(stream, f"{folder}-log", f"{folder}-cp")
    so.accepted_job(stream, f"{folder}-accepted", f"{folder}-cp1")
    so.seller_daily_job(so.log_stream(spark, f"{folder}-accepted"), f"{folder}-days", f"{folder}-cp2")
    days = so.current_seller_days(spark, f"{folder}-days", so.late_events(*logs(spark, folder)))
    return {str(r.day.date()): (r.events, r.sales, float(r.amount)) for r in days.collect()}


def test_seller_days_and_late_events(spark, feed):
    first = [event(1, "a", "delivered", 1, 0), event(2, "b", "delivered", 1, 1)]
    second = [event(1, "a", "delivered", 1, 0), event(3, "c", "delivered", 1, 2), event(4, "d", "paid", 1, 240)]
    third, fourth = [event(6, "f", "delivered", 1, 239)], [event(5, "e", "delivered", 1, 3), event(1, "a", "delivered", 1, 0)]
    stream, _, folder = feed(first, second, third, fourth)
    assert run_days(spark, folder, stream) == {"2024-01-10": (4, 4, 40.0), "2024-01-20": (1, 0, 0.0), "2024-01-19": (1, 1, 10.0)}
    # The copy of e1 comes late as well, but it was accepted before.
    assert [r.event_id for r in so.late_events(*logs(spark, folder)).collect()] == ["e5"]
    assert sorted(r.event_id for r in logs(spark, folder)[1].collect()) == ["e1", "e2", "e3", "e4", "e6"]
    curve = so.monthly_curve(so.current_seller_days(spark, f"{folder}-days", so.late_events(*logs(spark, folder)))).first()
    assert (curve.month, curve.sales, curve.amount) == ("2024-01", 5, 50.0)


def test_days_over_several_runs(spark, feed):
    """Micro-batch by micro-batch, out of order and with copies, beside the batch twin; a batch writes its own groups only."""
    import random

    rng = random.Random(3)
    folder = fresh_folder(spark, "runs")
    rows, last = [], 0
    for n in range(5):
        new = [event(100 * n + i, f"o{rng.randrange(9)}", rng.choice(["paid", "delivered"]), i, rng.randrange(max(0, 48 * n - 120), 48 * n + 30), amount=i) for i in range(25)]
        sent = new + rng.sample(new, 5) + (rng.sample(rows, 5) if rows else [])
        spark.createDataFrame(sent, RAW).coalesce(1).write.parquet(f"{folder}/part={n}")
        rows += new
        got = run_days(spark, folder, spark.readStream.schema(RAW).parquet(f"{folder}/part=*"))
        good = so.good_events(so.parsed_events(spark.createDataFrame(rows, RAW)))
        assert got == {str(r.day.date()): (r.events, r.sales, float(r.amount)) for r in so.seller_daily(good).collect()}
        days = spark.read.parquet(f"{folder}-days")
        accepted = logs(spark, folder)[1].count()
        touched = days.where(F.col("batch_id") == days.agg(F.max("batch_id")).scalar()).count()
        assert accepted > last and touched <= 8
        last = accepted
    assert so.late_events(*logs(spark, folder)).count() + last == len(rows) and last < len(rows)


def test_known_ids_are_forgotten(spark, feed):
    """The state holds the ids of the span behind the newest event, not those of the whole stream."""
    batches = [[event(100 * n + i, "o", "paid", i, 72 * n) for i in range(20)] for n in range(6)]
    stream, _, folder = feed(*batches)
    query = so.accepted_job(stream, f"{folder}-accepted", f"{folder}-cp")
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept and max(kept) <= 60 and so.log_table(spark, f"{folder}-accepted").count() == 120


def test_a_repeated_batch_counts_sales_once(spark, feed):
    rows = [event(1, "a", "delivered", 1, 0), event(2, "b", "delivered", 1, 1)]
    stream, _, folder = feed(rows)
    want = {"2024-01-10": (2, 2, 20.0)}
    assert run_days(spark, folder, stream) == want
    # What a second attempt of the batch may leave behind: other files that were never committed to a log.
    for log in (f"{folder}-log", f"{folder}-accepted"):
        committed = spark.read.parquet(log)
        spark.createDataFrame(committed.collect(), committed.schema).write.mode("append").partitionBy("event_date").parquet(f"{log}-again")
        spark.read.parquet(f"{log}-again").drop("event_date").write.mode("append").parquet(f"{log}/event_date=2024-01-10")
    assert run_days(spark, folder, stream) == want
    assert spark.read.parquet(f"{folder}-log").count() == 2


def test_jobs_take_a_trigger(spark, feed):
    stream, _, folder = feed([event(1, "a", "delivered", 1, 0)])
    query = so.log_job(stream, f"{folder}-log", f"{folder}-cp", {"processingTime": "1 second"})
    assert query.isActive
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{folder}-log").count() == 1


def alerts_of(spark, feed, *batches):
    """Alerts of the stream over all batches; they are those of the batch twin."""
    stream, batch, folder = feed(*batches)
    so.progress_job(stream, f"{folder}-progress", f"{folder}-cp")
    assert spark.read.parquet(f"{folder}-progress").select("batch_id").distinct().count() >= len(batches)
    got = sorted(tuple(r) for r in so.current_alerts(spark, f"{folder}-progress").collect())
    assert got == sorted(tuple(r) for r in so.late_alerts(so.good_events(so.parsed_events(batch))).collect())
    return [r[0] for r in got]


def test_one_alert_per_order(spark, feed):
    first = [event(1, "late", "shipped", 1, 0, due_hours=5), event(2, "fine", "delivered", 1, 4, due_hours=5)]
    second = [event(3, "other", "paid", 1, 10), event(4, "late", "shipped", 2, 11, due_hours=6)]
    third = [event(5, "late", "shipped", 3, 50, due_hours=7), event(6, "late", "delivered", 4, 60, due_hours=7)]
    assert alerts_of(spark, feed, first) == []
    assert alerts_of(spark, feed, first, second) == ["late"]
    assert alerts_of(spark, feed, first, second, third[:1]) == ["late"]
    assert alerts_of(spark, feed, first, second, third) == []


def test_old_orders_stay_settled(spark, feed):
    batches = [
        [event(1, "x", "shipped", 2, 1, due_hours=5), event(2, "y", "shipped", 1, 1, due_hours=5)],
        [event(3, "x", "delivered", 3, 10, due_hours=5), event(4, "z", "delivered", 1, 12, due_hours=900)],
        [event(5, "w", "delivered", 1, 24 * 40)],
        # Long after: a first event of a closed order, one more of an alerted order, a copy.
        [event(6, "x", "shipped", 1, 0, due_hours=4), event(7, "y", "shipped", 2, 24 * 60, due_hours=6), event(3, "x", "delivered", 3, 10, due_hours=5)],
        [event(8, "w", "delivered", 2, 24 * 80)],
    ]
    assert alerts_of(spark, feed, *batches) == ["y"]


def test_dead_letters(spark, feed):
    rows = [event(1, "a", "created", 1, 0), ("x", T0, "{oops"), ("y", T0, '{"order_id": "a"}'), ("z", T0, None)]
    stream, _, folder = feed(rows)
    so.split_job(stream, f"{folder}-split", f"{folder}-cp")
    assert spark.read.parquet(f"{folder}-split/good").count() == 1
    dead = spark.read.parquet(f"{folder}-split/dead")
    assert sorted(r.event_id for r in dead.collect()) == ["x", "y", "z"]


def test_sink_can_repeat_a_batch(spark, feed):
    rows = [event(1, "late", "shipped", 1, 0, due_hours=5), event(2, "b", "paid", 1, 10)]
    _, batch, folder = feed(rows)
    good = so.good_events(so.parsed_events(batch))
    sink = so.overwrite_sink(f"{folder}-progress")
    for batch_id in (0, 0, 1, 1):
        sink(so.order_progress(good, F.max("event_time").alias("clock")), batch_id)
    assert spark.read.parquet(f"{folder}-progress").where(F.col("batch_id") == 0).count() == 2
    assert [r.order_id for r in so.current_alerts(spark, f"{folder}-progress").collect()] == ["late"]


def test_reviews_are_worked_on_once(spark, feed):
    schema = "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string"
    first = [("r1", "o", 1, None, "achei a cor muito feia"), ("r2", "o", 5, None, "achei a cor muito feia"), ("r3", "o", 1, None, None)]
    second = [("r1", "o", 1, None, "achei a cor muito feia"), ("r4", "o", 2, None, "quebrado")]
    stream, _, folder = feed(first, second, schema=schema)
    sr.review_job(stream, f"{folder}-out", f"{folder}-cp", "v1")
    got = spark.read.parquet(f"{folder}-out/texts")
    assert sorted((r.review_id, r.route) for r in got.collect()) == [("r1", "small_llm"), ("r4", "rule")]


def test_known_reviews_are_remembered_over_runs(spark, feed):
    schema = "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string"
    folder = fresh_folder(spark, "runs")
    text, other = "achei a cor muito feia", "nao gostei nada do tecido dele"
    arrivals = [
        [("r5", "o", 1, None, text), ("r6", "o", 1, None, text)],
        [("r5", "o", 1, None, text), ("r2", "o", 1, None, text.upper()), ("r5", "o", 1, None, other)],
        [("r2", "o", 1, None, text.upper()), ("r6", "o", 1, None, text)],
    ]
    for n, rows in enumerate(arrivals):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/part={n}")
        query = sr.review_job(spark.readStream.schema(schema).parquet(f"{folder}/part=*"), f"{folder}-out", f"{folder}-cp", "v1")
    done = spark.read.parquet(f"{folder}-out/texts")
    assert sorted((r.review_id, r.raw_text) for r in done.collect()) == [("r2", text.upper()), ("r5", text), ("r5", other)]
    assert done.select("batch_id").distinct().count() == 2
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 4
    now = sr.current_texts(spark, f"{folder}-out").collect()
    assert sorted((r.review_id, r.raw_text) for r in now) == [("r2", text.upper()), ("r5", other)]
    # Another model version does all of it again.
    sr.review_job(spark.readStream.schema(schema).parquet(f"{folder}/part=*"), f"{folder}-two", f"{folder}-cp2", "v2")
    assert sr.current_texts(spark, f"{folder}-two").count() == 2


def test_days_are_reconciled_once_complete(spark):
    from datetime import date

    from tallyloom.operators import marketplace as mk
    from tallyloom.streaming.reconciliation import reconcile_job

    totals = "day date, orders long, gmv decimal(22,2), canceled long, reviews long"
    folder = fresh_folder(spark, "reconcile")

    def day(n, orders):
        return (date(2024, 1, 1) + timedelta(days=n), orders, Decimal(10 * orders), 1, 2)

    # Day 2 is served late but in time, day 3 never, day 21 is unknown to the source; days 40 and 41 still wait.
    source = [[day(0, 5), day(1, 5), day(2, 4), day(3, 3)], [day(5, 6)], [day(20, 8)], [day(40, 1), day(41, 1)]]
    served = [[day(0, 5), day(1, 6)], [day(2, 4), day(5, 6)], [day(20, 8), day(21, 2)], [day(40, 1)]]
    done = []
    for n, sides in enumerate(zip(source, served, strict=True)):
        streams = []
        for name, rows in zip(("source", "served"), sides, strict=True):
            spark.createDataFrame(rows, totals).coalesce(1).write.parquet(f"{folder}/{name}/part={n}")
            streams.append(spark.readStream.schema(totals).parquet(f"{folder}/{name}/part=*"))
        reconcile_job(*streams, f"{folder}/days", f"{folder}/cp")
        done.append({r.day for r in spark.read.parquet(f"{folder}/days").collect()})
    first = [str(day(n, 0)[0]) for n in range(42)]
    assert done[0] == {first[0], first[1]}
    assert done[1] == done[0] | {first[2], first[5]}
    assert done[2] == done[1] | {first[20], first[3]}  # day 3 was given up
    assert done[3] == done[2] | {first[40], first[21]}
    sides = [spark.createDataFrame([r for part in rows for r in part], totals) for rows in (source, served)]
    want = {str(r) for r in mk.reconcile(*sides).collect() if r.day != first[41]}
    got = spark.read.parquet(f"{folder}/days").collect()
    assert {str(r) for r in got} == want and len(got) == len(want)

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import marketplace as mk

DAY = datetime(2017, 3, 1)


@pytest.fixture(scope="module")
def tables(spark):
    def frame(name, *rows):
        return spark.createDataFrame(list(rows), schemas.MARKETPLACE[name])

    from decimal import Decimal as D

    def order(key, customer, status, took=None, due=10):
        arrived = DAY + timedelta(days=took) if took else None
        return (key, customer, status, DAY, DAY, DAY, arrived, DAY + timedelta(days=due))

    def item(key, n, seller, price):
        return (key, n, "p", seller, DAY, D(price), D("1.00"))

    def review(key, n, score):
        return (f"{key}-{n}", key, score, None, "x", DAY, DAY)

    return {
        "orders": frame(
            "orders",
            order("o1", "c1", "delivered", 4),
            order("o2", "c1", "delivered", 12),
            order("o3", "c2", "delivered"),
            order("o4", "c2", "canceled"),
            order("o5", "c3", "delivered", 2),
        ),
        "items": frame(
            "order_items",
            item("o1", 1, "s1", "10.00"),
            item("o1", 2, "s1", "30.00"),
            item("o2", 1, "s2", "5.50"),
            item("o4", 1, "s2", "99.00"),
            item("o5", 1, "s3", "41.00"),
        ),
        "reviews": frame("order_reviews", review("o1", 1, 5), review("o1", 2, 2), review("o2", 1, 3), review("o3", 1, 1)),
        "customers": frame(
            "customers",
            ("c1", "u1", "01000", "São Paulo", "SP"),
            ("c2", "u2", "01000", "SAO BERNARDO", "SP"),
            ("c3", "u3", "20000", "Rio", "RJ"),
        ),
        "sellers": frame("sellers", ("s1", "1", "a", "SP"), ("s2", "1", "a", "SP"), ("s3", "1", "a", "SP")),
    }


def test_naive_figures_equal_the_real_join(spark, tables):
    t = tables
    chosen = mk.filtered_orders(t["orders"], t["customers"], "sao", datetime(2017, 1, 1))
    got = mk.fanout_naive(chosen, t["items"], t["reviews"]).first()
    joined = chosen.join(t["items"], "order_id", "left").join(t["reviews"], "order_id", "left")
    want = joined.agg(F.count_distinct("order_id"), F.sum("price"), F.avg("review_score")).first()
    assert got.orders == want[0] == 3
    assert got.revenue == float(want[1]) == 85.5
    assert got.avg_score == pytest.approx(want[2], abs=1e-4)
    safe = mk.fanout_safe(chosen, t["items"], t["reviews"]).first()
    assert (safe.orders, safe.revenue, safe.avg_score) == (3, 45.5, 2.5)
    gap = mk.fanout_inflation(chosen, t["items"], t["reviews"]).first()
    assert gap.inflation == 40.0


def test_monthly(tables):
    r = mk.monthly_metrics(tables["orders"], tables["items"]).first()
    assert (r.month, r.total_orders, r.delivered_orders, r.canceled_orders) == ("2017-03", 5, 4, 1)
    assert (r.cancel_rate, r.delivered_gmv, r.avg_delivery_days) == (20.0, 90.5, 6.0)


def test_sellers(tables):
    t = tables
    m = mk.seller_metrics(t["orders"], t["items"], t["reviews"], t["sellers"], 2017)
    got = {r.seller_id: r for r in mk.top_sellers(m).collect()}
    assert got["s1"].gmv == got["s3"].gmv == 42.0 and got["s1"].order_count == 1
    assert (got["s1"].state_rank, got["s3"].state_rank, got["s2"].state_rank) == (1, 1, 3)
    assert got["s1"].avg_review_score == 3.5 and got["s3"].avg_review_score is None
    assert (got["s2"].late_delivery_rate, got["s2"].cancel_rate) == (100.0, 50.0)


def test_reconcile(tables):
    t = tables
    a = mk.day_totals(t["orders"], t["items"], t["reviews"])
    b = mk.day_totals(t["orders"].where("order_id != 'o4'"), t["items"], t["reviews"])
    assert mk.reconcile(a, a).first().matches
    r = mk.reconcile(a, b).first()
    assert (r.orders_diff, r.gmv_diff, r.canceled_diff, r.reviews_diff, r.matches) == (1, 99, 1, 0, False)


def test_city_search_folds_both_sides(spark):
    cities = [("São Paulo",), ("Sa\u0303o Vicente",), ("SAO BERNARDO",), ("Santos",), (None,)]
    rows = spark.createDataFrame(cities, "customer_city string")
    for needle in ("sao", "São", "SA\u0303O"):
        assert mk.city_search(rows, needle).count() == 3


def test_children_are_filtered_before_they_are_aggregated(tables):
    t = tables
    chosen = mk.filtered_orders(t["orders"], t["customers"], "sao", datetime(2017, 1, 1))
    plan = mk.fanout_safe(chosen, t["items"], t["reviews"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2


def test_only_the_asked_table_is_written(spark, monkeypatch):
    """A query on one table out of CSV writes that one, compressed; cells with line breaks, quotes and blanks come back."""
    from tallyloom import catalog, schemas

    row = {"review_id": "a", "order_id": ' x "y"\nz, ', "review_score": 3}
    names = ("orders", "order_items", "order_reviews")
    tables = {name: spark.createDataFrame([row] if name == "order_reviews" else [], schemas.MARKETPLACE[name]) for name in names}
    monkeypatch.setattr(catalog.bindings, "marketplace", lambda spark, sf_dir: tables)
    written, write = [], catalog.files.write_csv
    monkeypatch.setattr(catalog.files, "write_csv", lambda df, path, *a: written.append((path.rsplit("/", 1)[1], *a)) or write(df, path, *a))
    got = catalog.csv_rows(spark, "made-up-rows", "order_reviews")
    assert [r.asDict() for r in got.select(*row).collect()] == [row]
    assert written == [("order_reviews", "gzip")]
    catalog.csv_rows(spark, "made-up-rows", "order_reviews")
    assert len(written) == 1

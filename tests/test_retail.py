from datetime import datetime, timedelta

import pytest

from tallyloom import schemas
from tallyloom.functions.stock import stock_category
from tallyloom.operators import etl, profile, retail
from tallyloom.plans import retail_etl
from tallyloom.sources import files
from pyspark.sql import functions as F

T0 = datetime(2011, 1, 10, 12, 0)


def line(invoice="536365", code="22423", qty=1, price=2.0, at=T0, customer="1", country="EIRE", text="CAKE"):
    return (invoice, code, text, qty, at, price, customer, country)


def lines(spark, *data):
    return spark.createDataFrame(list(data), schemas.RETAIL)


def work(spark, *data):
    return retail.retail_work(lines(spark, *data))


@pytest.mark.parametrize(
    "code, category",
    [
        ("85123A", "product_like"),
        (" 22423 ", "product_like"),
        ("\t22423", "product_like"),
        ("22423\n", "product_like"),
        ("22423\nX", "other_non_product_or_unknown"),
        ("\u00a0POST", "postage_carriage_dotcom"),
        ("POST", "postage_carriage_dotcom"),
        ("m", "manual_adjustment"),
        ("D", "discount"),
        ("B", "fees_commission_bad_debt"),
        ("gift_0001_10", "gift_voucher"),
        ("DCGS0003", "sample_test_internal"),
        ("S", "sample_test_internal"),
        ("C3", "other_non_product_or_unknown"),
    ],
)
def test_stock_category(spark, code, category):
    df = spark.createDataFrame([(code,)], "code string")
    assert df.select(stock_category(F.col("code"))).first()[0] == category


def test_flags(spark, rows):
    w = work(
        spark,
        line("1"),
        line("C2", qty=-1),
        line("C3", qty=1),
        line("A4", price=-5.0),
        line("5", qty=-3, price=0.0),
        line("6", customer=None, text=None),
        line("c7"),
    )
    got = {r["invoice"]: r for r in rows(w)}
    assert got["1"]["is_gross_sale"] and got["1"]["is_net_line"]
    assert got["C2"]["is_cancellation"] and got["C2"]["is_net_line"] and not got["C2"]["is_gross_sale"]
    assert not got["C3"]["is_gross_sale"]
    assert got["A4"]["is_bad_debt"] and not got["A4"]["is_net_line"]
    assert got["5"]["is_damage"]
    assert got["6"]["is_customer_missing"] and got["6"]["is_description_missing"]
    assert not got["c7"]["is_cancellation"] and got["c7"]["invoice_prefix"] == "c"
    assert not got["c7"]["is_gross_sale"]


def test_white_space_around_codes_is_no_part_of_them(spark):
    w = work(spark, line(code="\t22423"), line(code="22423\n"), line(code="22423"))
    assert {(r.stock_code, r.is_gross_sale) for r in w.collect()} == {("22423", True)}


def test_customer_id(spark):
    df = spark.createDataFrame([("13085.0",), (" 77 ",), ("guest-1",), ("1.5",), (None,)], "c string")
    got = [r[0] for r in df.select(retail.normalize_customer_id(F.col("c"))).collect()]
    assert got == ["13085", "77", "guest-1", "1.5", None]


def test_aliases_and_missing_columns(spark):
    raw = lines(spark, line()).withColumnsRenamed({"Invoice": "InvoiceNo", "Price": "UnitPrice"})
    assert files.conform_retail(raw).columns == schemas.RETAIL.names
    with pytest.raises(ValueError, match="Country"):
        files.conform_retail(raw.drop("Country"))


def test_csv_with_bom_quotes_and_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        '﻿review_id,order_id,review_score,review_comment_title,review_comment_message,'
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,1,"a ""b""","line 1\nline 2",2018-01-01 00:00:00,2018-01-02 10:00:00\n',
        encoding="utf-8",
    )
    df = files.read_marketplace(spark, {"order_reviews": str(path)})["order_reviews"]
    r = df.first()
    assert (r.review_id, r.review_score, r.review_comment_title) == ("r1", 1, 'a "b"')
    assert r.review_comment_message == "line 1\nline 2"
    assert r.review_answer_timestamp == datetime(2018, 1, 2, 10)


def test_return_match(spark):
    h = timedelta(hours=1)
    d = timedelta(days=1)
    w = work(
        spark,
        line("100", at=T0 - 40 * d, qty=2),
        line("101", at=T0 - 2 * h, qty=2),
        line("102", at=T0 - 2 * h, qty=2),
        line("103", at=T0, qty=2),
        line("104", at=T0 + h, qty=2),
        line("105", at=T0 - h, qty=3),
        line("C1", at=T0, qty=-2),
        line("C2", at=T0, qty=-2),
        line("C3", at=T0 - 3 * h, qty=-2),
        line("C4", at=T0 - 41 * d, qty=-2),
        line("C5", at=T0, qty=-2, customer=None),
        line("C6", at=T0, qty=-2, code="POST"),
        line("C7", at=T0, qty=-4),
        line("C8", at=T0, qty=2),
        line("C9", at=T0 + 2 * h, qty=-2),
    )
    log = etl.returns_log(w, etl.sales_facts(w))
    got = {r.invoice_no: r.matched_original_invoice for r in log.collect()}
    assert got == {
        "C1": "102", "C2": "102", "C3": "100", "C4": None, "C5": None, "C6": None, "C7": None,
        "C8": None, "C9": "104",
    }


def test_return_match_against_brute_force(spark):
    import random

    rnd = random.Random(7)
    data = []
    for n in range(600):
        sale = rnd.random() < 0.6
        data.append(
            line(
                f"{'' if sale else 'C'}{1000 + n}",
                code=rnd.choice(["1", "2", "3A"]),
                qty=rnd.choice([1, 2]) * (1 if sale else -1),
                at=T0 + timedelta(hours=rnd.randrange(0, 200)),
                customer=rnd.choice(["1"] * 8 + ["2", None]),
            )
        )
    w = work(spark, *data)
    got = {r.invoice_no: r.matched_original_invoice for r in etl.returns_log(w, etl.sales_facts(w)).collect()}
    want = {}
    for r in data:
        if not r[0].startswith("C"):
            continue
        fits = [
            (s[4], s[0])
            for s in data
            if not s[0].startswith("C") and r[6] and s[6] == r[6] and s[1] == r[1] and s[3] == -r[3] and s[4] < r[4]
        ]
        want[r[0]] = max(fits)[1] if fits else None
    assert got == want


def test_recency_counts_whole_days(spark):
    w = work(
        spark,
        line("1", at=T0 - timedelta(hours=23), customer="a"),
        line("2", at=T0 - timedelta(hours=25), customer="b"),
        line("C3", at=T0, qty=-1, customer="c"),
    )
    got = {r.customer_id: r for r in etl.customer_features(etl.sales_facts(w), w).collect()}
    assert {k: r.recency_days for k, r in got.items()} == {"a": 0, "b": 1}
    assert got["a"].is_one_time_buyer


def test_primary_country_tie(spark):
    w = work(spark, line("1", country="Spain"), line("2", country="Italy"), line("3", country=None))
    assert etl.primary_country(etl.sales_facts(w)).first().country == "Italy"


def test_missing_buckets_overlap(spark, rows):
    w = work(
        spark,
        line("C1", qty=1, customer=None),
        line("2", qty=-1, price=5.0, customer=None),
    )
    got = {r["bucket"]: r["rows"] for r in rows(profile.customer_missing_buckets(w))}
    assert got["normal positive line: Quantity > 0 and Price > 0"] == 1
    assert got["cancellation / return: C invoice"] == 1
    assert sum(got.values()) == 2


def test_duplicates_are_all_listed(spark):
    df = lines(spark, *([line("1")] * 7), *([line("2", customer=None)] * 2), line("3"))
    out = profile.duplicate_rows(df, chunk=3)
    assert sorted(r.Invoice for r in out.collect()) == ["1"] * 7 + ["2"] * 2
    check = profile.duplicate_check(df, retail.retail_work(df)).first()
    assert check.exact_duplicate_rows == 7


def test_sales_identity_and_published_tables(spark, tmp_path):
    data = [line(str(n), at=T0 + timedelta(hours=n), qty=n % 3 + 1) for n in range(30)]
    data += [line(f"C{n}", at=T0 + timedelta(hours=n + 31), qty=-1) for n in range(3)]
    summary = {r.metric: r.value for r in retail_etl.run(lines(spark, *data), str(tmp_path)).collect()}
    assert summary["sales_facts_rows"] == 30 and summary["returns_log_rows"] == 3
    tables = retail_etl.read_published(spark, str(tmp_path))
    facts = tables["sales_facts"]
    gross = {r.measure: r.amount for r in profile.sales_measures(work(spark, *data)).collect()}
    assert facts.agg(F.sum("total_amount")).first()[0] == gross["gross_product_sales"]
    assert tables["returns_log"].count() == 3
    # A second run is a version of its own; readers see the newer one as a whole.
    retail_etl.run(lines(spark, *data[:10]), str(tmp_path))
    again = retail_etl.read_published(spark, str(tmp_path))
    assert again["sales_facts"].count() == 10 and again["returns_log"].count() == 0


def test_violations_raise(spark):
    w = work(spark, line("1", qty=-1))
    facts = retail.fact_columns(w)
    bad = etl.output_violations(facts, etl.customer_features(facts, w), etl.returns_log(w, facts))
    with pytest.raises(ValueError, match="sells at least one piece: 1"):
        etl.require_no_violations(bad)


def test_checks_are_counted_while_writing(spark, tmp_path, monkeypatch):
    data = [line(str(n), at=T0 + timedelta(hours=n)) for n in range(30)]
    retail_etl.run(lines(spark, *data), str(tmp_path / "good"))
    found = {r.rule: r.violations for r in retail_etl.read_checks(spark, str(tmp_path / "good")).collect()}
    assert set(found) == {rule for rules in etl.output_rules().values() for rule in rules} and set(found.values()) == {0}
    retail_etl.run(lines(spark, line("C1", qty=-1)), str(tmp_path / "none"))  # tables without rows break no rule
    assert retail_etl.read_checks(spark, str(tmp_path / "none")).where("violations > 0").count() == 0
    # Facts that break rules are not published; each rule says how many rows.
    facts = etl.sales_facts
    broken = F.when(F.pmod(F.crc32("invoice_no"), F.lit(2)) == 0, -F.col("quantity")).otherwise(F.col("quantity"))
    monkeypatch.setattr(etl, "sales_facts", lambda w: facts(w).withColumn("quantity", broken))
    n = facts(work(spark, *data)).where(F.pmod(F.crc32("invoice_no"), F.lit(2)) == 0).count()
    with pytest.raises(ValueError, match=f"sells at least one piece: {n}"):
        retail_etl.run(lines(spark, *data), str(tmp_path / "bad"))
    assert not (tmp_path / "bad" / "published").exists()

"""What queries write and read on their way, on tables made here."""

import pytest
from pyspark.sql import functions as F

from tallyloom import catalog
from tallyloom.functions import fixed_values as fv, text as tx
from tallyloom.operators import etl, profile, retail, reviews as rv
from tallyloom.plans import retail_etl
from tallyloom.sources import bindings


@pytest.fixture()
def sf_dir(spark, tmp_path):
    day = "timestamp_ntz'1997-01-01' + make_dt_interval(cast(id % 40 as int))"
    tables = {
        "nation": "select cast(id as int) n_nationkey, concat('N', id) n_name from range(6)",
        "customer": "select id c_custkey, cast(id % 6 as int) c_nationkey from range(30)",
        "part": "select id p_partkey, concat('type ', id % 5) p_type from range(40)",
        "orders": f"select id * 1000 + if(id % 3 = 0, 7, id) o_orderkey, id % 30 o_custkey, {day} o_orderdate from range(60)",
        "lineitem": """select o * 1000 + if(o % 3 = 0, 7, o) l_orderkey, (o * 3 + n) % 40 l_partkey, n % 7 l_suppkey, cast(n as int) l_linenumber,
            cast(10 * (1 + n % 2) as double) l_quantity, 90000.0d l_extendedprice, 0.0d l_discount, 0.0d l_tax,
            element_at(array('R', 'A', 'N'), cast(1 + (o + n) % 3 as int)) l_returnflag
            from (select id o from range(60)) cross join (select id + 1 n from range(6))""",
        "documents": "select id doc_id, concat('linha ', id, '\\nnunca chegou ', id % 4) text from range(20)",
    }
    for name, statement in tables.items():
        spark.sql(statement).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def refuse(*names):
    def use(*args, **kwargs):
        raise AssertionError(f"{names} used")

    return use


def test_negative_prices_are_found_without_staged_lines(spark, sf_dir, rows, monkeypatch):
    want = rows(profile.negative_price_rows(catalog.work(spark, sf_dir)), "invoice", "stock_code")
    monkeypatch.setattr(catalog, "staged", refuse("staged"))
    found = catalog.QUERIES["negative_price_rows"](spark, sf_dir)
    assert rows(found, "invoice", "stock_code") == want and len(want) > 5


def test_a_filter_on_prices_reaches_the_items(spark, sf_dir):
    plan = bindings.retail_lines(spark, sf_dir).where("Price < 0")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    above = lines[next(n for n, part in enumerate(lines) if "l_returnflag" in part and "Relation" in part) - 1]
    assert "Filter" in above and "< 0.0" in above


def test_eligible_returns_need_no_classified_lines(spark, sf_dir, rows, monkeypatch):
    want = rows(etl.cancellations(catalog.work(spark, sf_dir)).where(etl.eligible_return()), "invoice_no", "stock_code")
    monkeypatch.setattr(catalog, "work", refuse("work"))
    found = catalog.QUERIES["eligible_returns"](spark, sf_dir)
    assert rows(found, "invoice_no", "stock_code") == want and len(want) > 5


def test_instants_of_returns_are_made_once(spark, sf_dir, monkeypatch):
    written = []

    def stored(df, label):
        written.append(label)
        return df.localCheckpoint()

    monkeypatch.setattr(etl, "stored", stored)
    w = retail.retail_work(bindings.retail_lines(spark, sf_dir))
    log = etl.returns_log(w, etl.sales_facts(w))
    assert written == ["instants"]
    assert log.count() == w.where("is_cancellation").count()


def test_sales_and_returns_of_one_instant_and_of_later_days(spark):
    t = "timestamp_ntz'2020-01-01 {}:00:00'"
    row = "select '{}' invoice_no, '20001' stock_code, 'd' description, {}L quantity, 1.0d unit_price, 1.0d total_amount, {} invoice_datetime, '7' customer_id, 'X' country"
    sales = [("1", 2, t.format("08")), ("2", 2, t.format("08")), ("3", 2, t.format("09")), ("4", 2, "cast(null as timestamp_ntz)")]
    back = [("C1", -2, t.format("08")), ("C2", -2, t.format("09")), ("C3", -2, t.format("10")), ("C4", -2, "timestamp_ntz'2020-03-01 00:00:00'"), ("C5", -2, "cast(null as timestamp_ntz)")]
    facts, returns = (spark.sql(" union all ".join(row.format(*r) for r in part)) for part in (sales, back))
    got = {r.invoice_no: r.matched_original_invoice for r in etl.match_returns(returns, facts).collect()}
    assert got == {"C1": None, "C2": "2", "C3": "3", "C4": "3", "C5": None}


def test_only_the_asked_published_table_is_opened(spark, sf_dir, tmp_path):
    retail_etl.run(bindings.retail_lines(spark, sf_dir), f"{tmp_path}/out")
    one = retail_etl.read_published(spark, f"{tmp_path}/out", "returns_log")
    assert list(one) == ["returns_log"]
    assert one["returns_log"].count() == retail_etl.read_published(spark, f"{tmp_path}/out")["returns_log"].count() > 0


def test_records_do_not_write_all_reviews(spark, sf_dir, rows, monkeypatch):
    monkeypatch.setattr(catalog, "reviews", refuse("reviews"))
    low = catalog.records(spark, sf_dir)
    assert low.count() == bindings.reviews(spark, sf_dir).where(F.col("review_score") <= fv.LOW_SCORE_MAX).count() > 0


def test_near_duplicates_move_no_raw_text(spark, sf_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(catalog.near_texts, "near_duplicates", lambda texts: asked.append(texts) or texts)
    for name in ("records", "texts"):
        monkeypatch.setattr(catalog, name, refuse(name))
    catalog.QUERIES["near_duplicates"](spark, sf_dir)
    plan = asked[0].select("dedup_key", "normalized_text", "n_reviews")._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_text" not in plan.split("Aggregate")[1].split("\n")[0] and "review_id" not in plan
    want = rv.dedup_texts(rv.review_records(bindings.reviews(spark, sf_dir)))
    assert asked[0].count() == want.count() > 0


def test_outer_space_of_any_kind_is_stripped(spark):
    cases = {"20012\n": "20012", "\t20007A": "20007A", " 1 2 ": "1 2", "a ": "a", "　b c\x1c": "b c", "é ": "é", "d\x7f": "d\x7f", "": "", " ": "", "x": "x", "a\nb": "a\nb"}
    df = spark.createDataFrame([*cases.items(), (None, None)], "t string, want string")
    assert df.where(~tx.strip_space(F.col("t")).eqNullSafe(F.col("want"))).count() == 0
    plan = df.select(tx.strip_space(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in plan

import random
from collections import Counter
from datetime import datetime
from itertools import combinations

import pytest

from tallyloom import schemas
from tallyloom.operators import association, profile, retail


def basket_lines(spark, baskets):
    data = [
        (inv, item, f"item {item}", 1, datetime(2011, 1, 1), 1.0, "1", "France")
        for inv, items in baskets.items()
        for item in items
    ]
    return retail.retail_work(spark.createDataFrame(data, schemas.RETAIL))


def test_pairs_against_brute_force(spark):
    rnd = random.Random(5)
    items = [str(n) for n in range(100, 250)]
    baskets = {str(n): rnd.choices(items[:12], k=rnd.randrange(1, 8)) for n in range(60)}
    baskets["9000"] = items + items[:3]
    baskets["9001"] = items
    baskets["9002"] = ["100"]
    work = basket_lines(spark, baskets)
    rules = association.item_pair_rules(work, 3, 2, 50).collect()
    sets = {k: set(v) for k, v in baskets.items()}
    single = Counter(i for s in sets.values() for i in s)
    pairs, large = Counter(), Counter()
    for s in sets.values():
        for pair in combinations(sorted(i for i in s if single[i] >= 3), 2):
            pairs[pair] += 1
            large[pair] += len(s) >= 50
    want = {p: n for p, n in pairs.items() if n >= 2}
    assert {(r.left_code, r.right_code): r.pair_invoices for r in rules} == want
    for r in rules:
        a, b, both, n = single[r.left_code], single[r.right_code], r.pair_invoices, len(sets)
        assert r.lift == pytest.approx((both / n) / ((a / n) * (b / n)))
        assert r.imbalance_ratio == pytest.approx(abs(a - b) / (a + b - both))
        assert r.all_confidence_pct == pytest.approx(min(both / a, both / b) * 100)
        assert r.large_basket_pair_pct == round(large[(r.left_code, r.right_code)] / both * 100, 2)
        assert r.left_description == f"item {r.left_code}"


def test_basket_sizes(spark):
    work = basket_lines(spark, {"1": ["1"], "2": ["1", "2", "2"], "3": [str(n) for n in range(60)]})
    r = profile.basket_sizes(work).first()
    assert (r.gross_product_invoices, r.median_unique_products, r.max_unique_products) == (3, 2.0, 60)
    assert (r.invoices_with_50_plus_products, r.pct_invoices_with_50_plus_products) == (1, 33.33)


def test_flag_rules_leave_out_what_never_meets(spark):
    work = basket_lines(spark, {"1": ["1"], "C2": ["POST"]})
    got = {(r.left_flag, r.right_flag): r for r in association.flag_rules(work).collect()}
    assert set(got) == {("Cancellation_C_invoice", "Non_product_stockcode")}
    assert got[("Cancellation_C_invoice", "Non_product_stockcode")].lift == 2.0

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import fixed_values as fv
from tallyloom.operators import budget, evaluation, responses as rs, reviews as rv
from tallyloom.plans import review_extraction as plan

REVIEW = "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string"
LONG = "chegou diferente daquilo que estava na foto e nada combina com o sofa da minha sala nem com as outras coisas que comprei antes nesta mesma loja virtual de moveis usados"
MIXED = "gostei bastante da cor mas o tamanho veio menor que o esperado por mim e tambem achei o tecido um pouco aspero ao toque"


def routed(spark, *texts):
    data = [(f"r{n:03}", f"o{n}", 1, None, t) for n, t in enumerate(texts)]
    return rv.route_texts(rv.dedup_texts(rv.review_records(spark.createDataFrame(data, REVIEW))))


@pytest.mark.parametrize(
    "text, route, kinds, review",
    [
        (None, "rule", ["general.negative_low_detail"], True),
        ("ok", "rule", ["general.unclear"], True),
        ("Muito bom.", "rule", ["general.unclear"], True),
        ("Ruim.", "rule", ["general.negative_low_detail"], False),
        ("Produto chegou quebrado, embalagem rasgada. Pessimo!", "rule", ["product.defective"], False),
        (
            "Ainda nao recebi meu pedido e o vendedor nao respondeu minhas mensagens.",
            "rule",
            ["delivery.not_received", "service.no_response"],
            False,
        ),
        ("Não recebi o produto ainda, quero o reembolso", "rule", ["delivery.not_received", "service.refund_problem"], False),
        (LONG, "large_llm", None, None),
        (MIXED, "small_llm", None, None),
        (MIXED + " porem", "large_llm", None, None),
        ("achei a cor muito feia", "small_llm", None, None),
    ],
)
def test_rules_and_routes(spark, text, route, kinds, review):
    r = routed(spark, text).first()
    assert r.route == route
    if kinds is None:
        assert r.issues is None
    else:
        assert [f"{i.category}.{i.subcategory}" for i in r.issues] == kinds
        assert r.needs_manual_review == review
        assert all(i.evidence == (text or "")[:200] for i in r.issues)


def test_mixed_text_has_the_intended_length():
    assert fv.SMALL_MAX_CHARS - 2 <= len(MIXED) and len(MIXED + " porem") <= fv.LARGE_MIN_CHARS < len(LONG)


def test_missing_column(spark):
    with pytest.raises(ValueError, match="order_id"):
        rv.low_score_reviews(spark.createDataFrame([], REVIEW).drop("order_id"))


def test_duplicates_share_the_lowest_id(spark):
    data = [("b", "o", 2, "Ruim", None), ("a", "o", 3, None, " RUIM! "), ("c", "o", 4, None, "ruim")]
    r = rv.dedup_texts(rv.review_records(spark.createDataFrame(data, REVIEW))).collect()
    assert [(x.review_id, x.raw_text, x.n_reviews) for x in r] == [("a", "RUIM!", 2)]


@pytest.mark.parametrize("budget_tokens, digits, top", [(300, 1, 200), (300, 2, 400), (6000, 1, 300), (90, 2, 100)])
def test_batches_equal_one_pass(spark, budget_tokens, digits, top):
    rnd = random.Random(budget_tokens + digits)
    items = sorted((f"{rnd.getrandbits(160):040x}", rnd.randrange(81, top + 1)) for _ in range(400))
    df = spark.createDataFrame(items, "dedup_key string, tokens long")
    got = {r.dedup_key: r.batch_id for r in budget.pack_batches(df, budget_tokens, digits).collect()}
    filled, batch = 0, 0
    for key, tokens in items:
        if filled and filled + tokens > budget_tokens:
            filled, batch = 0, batch + 1
        filled += tokens
        assert got[key] == batch


def test_gate_stops_for_good(spark):
    calls = [(1, "0a", 1, 1, 100, 10, 50), (1, "0b", 2, 1, 100, 10, 50), (2, "0c", None, 1, 1, 1, 30), (2, "0d", None, 1, 1, 1, 1)]
    df = spark.createDataFrame(calls, "phase int, call_key string, batch_id long, items long, input_tokens long, output_tokens long, cost long")
    def accepted(cap):
        plan = budget.budget_gate(df, cap / budget.UNITS_PER_USD)
        return [r.accepted for r in plan.orderBy("phase", "call_key").collect()]
    assert accepted(100) == [True, True, False, False]
    assert accepted(99) == [True, False, False, False]
    assert accepted(131) == [True, True, True, True]


def test_cost_formula(spark):
    texts = spark.createDataFrame([("0a", "x" * 400)], "dedup_key string, raw_text string")
    r = budget.single_calls(texts, 2).first()
    assert (r.input_tokens, r.output_tokens) == (101 + 180, 450)
    assert r.cost / budget.UNITS_PER_USD == pytest.approx(281 * 2.5e-6 + 450 * 1e-5)


def test_sample_fills_up_in_order(spark):
    data = [(f"{n:02x}", "rule" if n < 20 else "small_llm" if n < 21 else "large_llm") for n in range(30)]
    df = spark.createDataFrame(data, "dedup_key string, route string")
    got = sorted(r.dedup_key for r in budget.route_sample(df, 9).collect())
    assert got == sorted([f"{n:02x}" for n in (0, 1, 2, 20, 21, 22, 23, 3, 4)])
    assert budget.route_sample(df, 0).count() == 30


def answer(category="delivery", subcategory="delay", evidence="cor muito", confidence=0.9, review=False, n=1):
    one = {"category": category, "subcategory": subcategory, "evidence": evidence, "confidence": confidence}
    return json.dumps({"issues": [one] * n, "needs_manual_review": review}, ensure_ascii=False)


@pytest.mark.parametrize(
    "raw, small, large",
    [
        (answer(), "accepted", "accepted"),
        (answer(evidence="COR  MUITO"), "accepted", "accepted"),
        (answer(confidence="0.8"), "accepted", "accepted"),
        ('{"issues": [', "schema_error", "schema_error"),
        (answer(category="weather"), "schema_error", "schema_error"),
        (answer(subcategory="defective"), "schema_error", "schema_error"),
        (answer(confidence=1.2), "schema_error", "schema_error"),
        (answer(n=0), "schema_error", "schema_error"),
        (answer(evidence="nada disso"), "evidence_error", "evidence_error"),
        (answer(confidence=0.69), "low_confidence", "low_confidence"),
        (answer(confidence=0.5, evidence="nada disso"), "low_confidence", "evidence_error"),
        (answer(evidence=None), "schema_error", "schema_error"),
        (None, "missing", "missing"),
    ],
)
def test_answers(spark, raw, small, large):
    texts = spark.createDataFrame([("k", "achei a cor muito feia")], "dedup_key string, raw_text string")
    answers = spark.createDataFrame([("k", "small", raw), ("k", "large", raw)], "dedup_key string, tier string, raw_json string")
    got = {r.tier: r.status for r in rs.validate_responses(answers, texts).collect()}
    assert got == {"small": small, "large": large}


def test_whole_run(spark, tmp_path):
    worth = "achei a cor muito feia e ninguem deu suporte"
    data = [
        ("r1", "o1", 1, None, "achei a cor muito feia"),
        ("r2", "o2", 2, None, "Achei a COR muito feia!"),
        ("r3", "o3", 3, "ok", None),
        ("r4", "o4", 1, None, LONG),
        ("r5", "o5", 1, None, "o tecido e fino demais"),
        ("r6", "o6", 5, None, "achei a cor muito feia"),
        ("r7", "o7", 1, None, None),
    ]
    reviews = spark.createDataFrame(data, REVIEW)
    routed_reviews = plan.route_reviews(reviews)
    keys = {r.review_id: r.dedup_key for r in routed_reviews.texts.collect()}
    assert set(keys) == {"r1", "r3", "r4", "r5", "r7"} and worth
    answers = spark.createDataFrame(
        [
            (keys["r1"], "small", answer(evidence="a cor muito feia")),
            (keys["r4"], "large", answer(evidence="na foto", confidence=0.6)),
            (keys["r5"], "small", answer(evidence="inventado")),
        ],
        "dedup_key string, tier string, raw_json string",
    )
    run = plan.with_answers(routed_reviews.texts, answers)
    out = {r.review_id: r for r in rs.expand_reviews(routed_reviews.records, run.results).collect()}
    assert {k: (r.method, r.needs_manual_review) for k, r in out.items()} == {
        "r1": ("small_llm", False),
        "r2": ("small_llm", False),
        "r3": ("rule", True),
        "r4": ("large_llm", True),
        "r5": ("offline_small_llm_fallback", True),
        "r7": ("rule", True),
    }
    assert out["r2"].issues[0].evidence == "a cor muito feia" and out["r7"].issues[0].evidence == ""
    counted = {(r.category, r.subcategory): r.issues for r in rs.issue_counts(routed_reviews.texts, run.results).collect()}
    listed = {}
    for r in out.values():
        for i in r.issues:
            listed[(i.category, i.subcategory)] = listed.get((i.category, i.subcategory), 0) + 1
    assert counted == listed
    assert {r.method: r.records for r in rs.method_counts(routed_reviews.texts, run.results).collect()}["small_llm"] == 2
    none = plan.with_answers(routed_reviews.texts, answers, cap_usd=0.0)
    # Answers to calls that the gate refused count neither as calls nor as errors.
    refused = plan.metadata(routed_reviews, none, none.results).first()
    assert (refused.llm_call_count, refused.schema_error_count, refused.evidence_error_count) == (0, 0, 0)
    methods = {r.method for r in none.results.collect()}
    assert methods == {"rule", "offline_small_llm_fallback", "offline_large_llm_fallback"}
    plan.run_offline(reviews, str(tmp_path / "off"))
    assert spark.read.json(str(tmp_path / "off/records")).count() == 6
    plan.run_with_answers(reviews, answers, str(tmp_path / "live"))
    meta = spark.read.json(str(tmp_path / "live/metadata")).first()
    assert spark.read.json(str(tmp_path / "live/records")).count() == 5
    assert (meta.record_count, meta.dedup_count, meta.empty_text_count, meta.evidence_error_count) == (6, 5, 1, 1)


def test_retry_after_a_failed_answer(spark):
    text = "achei a cor estranha e por isso pedi que mandassem outra peca igual a da foto mas ninguem fez nada de util"
    texts = routed(spark, text)
    assert texts.first().route == "small_llm"
    key = texts.first().dedup_key
    answers = spark.createDataFrame(
        [(key, "small", "{"), (key, "large", answer(evidence="a cor estranha"))],
        "dedup_key string, tier string, raw_json string",
    )
    r = plan.with_answers(texts, answers).results.first()
    assert (r.method, r.model, r.needs_manual_review) == ("large_llm", "large", False)


def test_accuracy(spark):
    data = [(1, "rule", 1, 2, 2, 0, 2, 0, 1), (2, "rule", 0, 1, 0, 1, 2, 1, 1), (2, "large_llm", 1, 1, 1, 0, 0, 0, 0)]
    judged = spark.createDataFrame(
        data,
        "batch int, method string, class_ok long, issues long, issues_supported long, issues_invented long, "
        "true_issues long, missed_issues long, actionable_ok long",
    )
    got = {(r.batch, r.method): r for r in evaluation.accuracy_metrics(judged).collect()}
    assert len(got) == 5
    total = got[(None, None)]
    assert (total.reviews, total.classification_accuracy_pct, total.evidence_compliance_pct) == (3, 66.7, 75.0)
    assert (total.missed_recall_pct, total.hallucination_pct) == (25.0, 25.0)
    assert got[(None, "large_llm")].missed_recall_pct is None


def test_cache(spark):
    records = spark.createDataFrame([("r1", "h1"), ("r2", "h2")], "review_id string, text_hash string")
    cache = spark.createDataFrame(
        [("r1", "h1", "v1"), ("r2", "h2", "v0"), ("r2", "hx", "v1")],
        "review_id string, text_hash string, model_version string",
    )
    assert [r.review_id for r in rv.cache_misses(records, cache, "v1").collect()] == ["r2"]


def test_written_results_are_checked(spark, tmp_path):
    from tallyloom.sources import files

    reviews = spark.createDataFrame([("r1", "o1", 1, None, "quebrado"), ("r2", "o2", 2, "a", "Linha um\nlinha \"dois\" é"), ("r3", "o3", 1, None, None)], REVIEW)
    plan.run_offline(reviews, str(tmp_path))
    sound = files.read_review_results(spark, str(tmp_path))
    files.require_sound_results(sound)
    known = plan.route_reviews(reviews)
    want = rs.expand_reviews(known.records, rs.offline_results(known.texts))
    assert sorted(map(str, sound.drop("defect").collect())) == sorted(map(str, want.collect()))
    meta = files.read_run_metadata(spark, str(tmp_path)).first()
    assert (meta.record_count, meta.llm_call_count, meta.budget_exhausted) == (3, 0, False)
    good = json.loads(next(x for f in (tmp_path / "records").glob("*.json") for x in f.read_text().splitlines()))
    one = good["issues"][0]
    lines = [
        "{oops", json.dumps(good | {"review_score": "many"}), json.dumps({k: v for k, v in good.items() if k != "method"}),
        json.dumps(good | {"issues": []}), json.dumps(good | {"issues": [one | {"category": "weather"}]}),
        json.dumps(good | {"issues": [one, one | {"confidence": 1.5}]}), json.dumps(good | {"issues": None}),
    ]
    (tmp_path / "records" / "more.json").write_text("\n".join(lines))
    again = files.read_review_results(spark, str(tmp_path))
    counts = {r.defect: r["count"] for r in again.groupBy("defect").count().collect()}
    assert counts == {None: 3, "not readable": 2, "missing field": 1, "no issue": 2, "unknown kind of issue": 1, "evidence or confidence out of range": 1}
    with pytest.raises(ValueError, match="missing field: 1; no issue: 2; not readable: 2"):
        files.require_sound_results(again)
    (tmp_path / "metadata" / "more.json").write_text("{}")
    with pytest.raises(ValueError):
        files.read_run_metadata(spark, str(tmp_path))

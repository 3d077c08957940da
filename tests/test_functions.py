import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.functions.ordered import running_total
from tallyloom.functions.quantiles import _fine_buckets, exact_quantiles, magnitude_bucket
from tallyloom.operators.profile import numeric_profile


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_equal_numpy(spark, seed):
    rnd = random.Random(seed)
    data = [("a", rnd.gauss(0, 1000)) for _ in range(500)] + [("b", float(rnd.randrange(-3, 4))) for _ in range(801)]
    data += [("c", 5.0), ("b", None)]
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    df = spark.createDataFrame(data, "g string, v double")
    got = {(r.g, r.p): r.quantile for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g in "abc":
        values = [v for k, v in data if k == g and v is not None]
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


TEXTS = {
    "": "",
    "Não RECEBI!! o produto... 100%": "nao recebi o produto 100",
    "Straße über Ærø — “ótimo”": "strasse uber ærø otimo",
    "caf&eacute; &amp; ch&aacute; &lt;b&gt;forte&lt;/b&gt;": "cafe cha forte",
    "<p class='x'>olá</p> https://exemplo.com/a?b=c www.x.com fim": "ola fim",
    "a\u200bb\ufeffc \ufb01m ½ ① Ⅳ": "abc fim 1 2 1 iv",
    "ΑΒΓ άλφα İstanbul ĞÜŞ": "αβγ αλφα istanbul gus",
    "日本語 ﾃｽﾄ": "日本語 テスト",
    "linha 1\nlinha 2\tTAB fim": "linha 1 linha 2 tab fim",
    "emoji 😀👍🏽 ok 🇧🇷": "emoji ok",
    "snake_case __x__ l'eau": "snake_case __x__ l eau",
    "e\u0301 combining": "e combining",
    "AT&T &unknown; &copy 2020": "at t unknown 2020",
    "WWW.SITE.COM/x HTTP://A.B": "",
}


def test_normalized_text(spark):
    df = spark.createDataFrame(enumerate(TEXTS), "n int, t string")
    got = {r.n: r.x for r in df.select("n", tx.normalize_text(F.col("t")).alias("x")).collect()}
    assert [got[n] for n in range(len(TEXTS))] == list(TEXTS.values())


def test_quotes(spark):
    cases = [
        ("Não  Recebi\no produto", "não recebi O PRODUTO", True),
        ("Nao recebi", "não recebi", False),
        ("caf&eacute; bom", "CAFÉ", True),
        ("", "", True),
        ("abc", "", False),
        ("Straße", "STRASSE", True),
    ]
    df = spark.createDataFrame([(n, t, [q]) for n, (t, q, _) in enumerate(cases)], "n int, t string, q array<string>")
    got = {r.n: r.f[0] for r in df.select("n", tx.quotes_found(F.col("t"), F.col("q")).alias("f")).collect()}
    assert [got[n] for n in range(len(cases))] == [c[2] for c in cases]


def test_running_total_over_blocks(spark):
    rnd = random.Random(3)
    data = [(f"{rnd.getrandbits(64):016x}", rnd.randrange(1, 50)) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, v long").withColumn("b", F.substring("k", 1, 1))
    got = {r.k: r.s for r in running_total(df, ["b"], ["k"], "v", "s").collect()}
    total = 0
    for k, v in sorted(data):
        total += v
        assert got[k] == total


def test_quantiles_of_many_values_in_a_narrow_range(spark):
    n = 200_000
    rng = np.random.default_rng(4)
    values = 100 + rng.random(n)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = {r.p: r.quantile for r in exact_quantiles(df, "v", [0.01, 0.5, 0.99]).collect()}
    for p, q in got.items():
        assert q == pytest.approx(np.quantile(values, p), rel=1e-14)
    negative = {r.p: r.quantile for r in exact_quantiles(df.selectExpr("-v AS v"), "v", [0.01, 0.5]).collect()}
    for p, q in negative.items():
        assert q == pytest.approx(np.quantile(-values, p), rel=1e-14)
    # What is put in order in the end shares all three steps.
    b = magnitude_bucket(F.col("v"))
    fine = df.select(b.alias("b"), *[c.alias(n) for c, n in zip(_fine_buckets(F.col("v"), b), "cd", strict=True)])
    assert max(r["count"] for r in fine.groupBy("b", "c", "d").count().collect()) <= 4


def test_profile_of_large_and_shifted_numbers(spark):
    big = spark.createDataFrame([(1e15,), (3e15,)], "v double")
    got = {r.metric: r.value for r in numeric_profile(big, ["v"]).collect()}
    assert got["mean"] == 2e15 and got["max"] == 3e15
    shifted = spark.createDataFrame([(1e9 + i / 1000,) for i in range(1000)], "v double")
    got = {r.metric: r.value for r in numeric_profile(shifted, ["v"]).collect()}
    assert got["std"] == 0.29


def _first_alternatives(parsed):
    """Every way through the branches and letter classes of a pattern; a repeat counts once."""
    ways = [""]
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            more = [chr(arg)]
        elif kind == "IN":
            more = [chr(v) for o, v in arg if str(o) == "LITERAL"] or [" "]
        elif kind == "BRANCH":
            more = [w for branch in arg[1] for w in _first_alternatives(branch)]
        elif kind == "SUBPATTERN":
            more = _first_alternatives(arg[-1])
        elif kind == "MAX_REPEAT":
            more = _first_alternatives(arg[2])
        else:
            more = [""]
        ways = [w + m for w in ways for m in more]
    return ways


def test_stems_lie_in_every_match():
    from re import _parser

    from tallyloom.functions import fixed_values as fv

    for (pattern, *_), stems in zip(fv.ISSUE_PATTERNS, fv.ISSUE_STEMS, strict=True):
        ways = _first_alternatives(_parser.parse(pattern))
        assert len(ways) > 2 and all(any(s in w for s in stems) for w in ways), pattern
    for pattern in (fv.LOW_INFORMATION_PATTERN, fv.POSITIVE_PATTERN):
        assert max(map(len, _first_alternatives(_parser.parse(pattern)))) <= fv.WHOLE_TEXT_MAX_CHARS


def test_cheap_tests_change_nothing(spark):
    texts = ["", " ", "a", "a b", " a", "a\n", " a　", "a \n b\r\n", "é ", "a b", "1 2 3 4", "1 2 3 4 5", "não gostei", "x" * 50, "<b", "a<b>http</b>://q r", "ht<i>tp://x", "HTTPS://X y", "w<b>ww.a b", "wWw.a é", "A&B", "ÀÉ ok_1"]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    t = F.col("t")
    assert df.where(~tx.trimmed(t).eqNullSafe(tx.strip_space(t))).count() == 0
    assert df.where(~tx._needs_tables(t).eqNullSafe(t.rlike(tx.NEEDS_TABLES))).count() == 0
    single = df.where("t in ('', 'a', 'a b', '1 2 3 4', '1 2 3 4 5')")
    assert single.where(tx.few_words(t, 4) != (tx.word_count(t) <= 4)).count() == 0
    bare = F.regexp_replace(F.regexp_replace(t, r"<[^>]+>", " "), f"(?i)https?://[^{tx.SPACE}]+|www\\.[^{tx.SPACE}]+", " ")
    slow = F.trim(F.regexp_replace(F.translate(tx._fold_native(bare), tx.ACCENTED, tx.BASE), r"[^\p{L}\p{N}_]+", " "))
    assert df.where(~t.rlike(tx.NEEDS_TABLES)).where(~tx.normalize_text(t).eqNullSafe(slow)).count() == 0
    found = tx.matches(t, "gostei", ["gost"], 20)
    assert df.where(found).count() == 1 and df.where(found.isNull()).count() == 1


def test_quotes_that_stand_in_the_text_meet_no_tables(spark):
    """The Python worker, which is slow on long texts, sees only texts whose quotes are not held as they stand."""
    cases = [
        ("日本語 fim", ["日本", "fim"], [True, True], False),
        ("日本語 Fim", ["日本", "fim"], [True, True], True),
        ("olá &amp; 日本", ["amp"], [False], True),
        ("AT&amp;T", ["T"], [True], True),
        ("ΑΒΓ", [None, "Α"], [None, True], True),
        ("日本", [""], [False], True),
        ("日本", [], [], False),
        ("a\u200bb", ["a\u200b", "ab"], [True, True], True),
    ]
    df = spark.createDataFrame([(n, t, q) for n, (t, q, *_) in enumerate(cases)], "n int, t string, q array<string>")
    got = df.select("n", tx.quotes_found(F.col("t"), F.col("q")).alias("f"), tx.quotes_need_tables(F.col("t"), F.col("q")).alias("h"))
    got = {r.n: (r.f, r.h) for r in got.collect()}
    assert [got[n] for n in range(len(cases))] == [(f, h) for _, _, f, h in cases]

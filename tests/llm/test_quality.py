import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import quality

SF = "/root/testdata/sf0.01"


def vectors_of(texts):
    raw = [t.encode() for t in texts]
    return quality.text_features(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_vectors_do_not_depend_on_neighbours():
    texts = ["", "One two, one TWO!", " \n", "a\nb\na\n", "héé ### |x|", "", "w " * 3000, "é", "\n\nlast line\n"]
    together = vectors_of(texts)
    assert together.shape == (len(texts), quality.WIDTH)
    for i, t in enumerate(texts):
        assert (vectors_of([t])[0] == together[i]).all()
    assert not together[0].any()


def test_measures_like_plain_counts():
    texts = ["The the the cat. SAT 12 on-the mat!", "one two three four five six one two three four five six", "a\nb\na\na"]
    start = quality.KINDS**2 + quality.BUCKETS
    got = vectors_of(texts)[:, start : start + quality.MEASURES] / 255
    for text, m in zip(texts, got, strict=True):
        words = text.split()
        lower = [w.lower() for w in words]
        n = len(words)
        grams = [tuple(lower[i : i + 5]) for i in range(n - 4)]
        lines = text.split("\n")
        want = {
            0: np.log1p(len(text)) / 20, 1: np.log1p(n) / 16, 2: sum(map(len, words)) / n / 20, 3: len(set(lower)) / n,
            4: max(map(lower.count, lower)) / n, 5: sum(a == b for a, b in zip(lower, lower[1:])) / n,
            6: sum(sum(c.isupper() for c in w) > 1 and not any(c.islower() for c in w) for w in words) / n,
            8: sum(w[-1] in ".,;:!?" for w in words) / n, 10: sum(any(c.isdigit() for c in w) for w in words) / n,
            11: 1 - len(set(grams)) / len(grams) if grams else 0, 12: 1 - len(set(lines)) / len(lines), 13: np.log1p(len(lines)) / np.log1p(len(text)),
        }
        for at, value in want.items():
            assert m[at] == pytest.approx(value, abs=0.003), at


def test_prior_of_mixed_scores():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.85):
        good, n = rng.normal(2, 1, 40000), 60000
        mixed = np.where(rng.random(n) < share, rng.normal(2, 1, n), rng.normal(-2, 1, n))
        bins = [np.histogram(1 / (1 + np.exp(-x)), quality.BINS, (0, 1))[0] for x in (good, mixed)]
        assert quality.best_bin_prior(*bins) == pytest.approx(share, abs=0.04)
    assert quality.best_bin_prior(np.zeros(5), np.zeros(5)) == 0.5


def test_risk_like_the_labelled_fit():
    """Where bad texts are apart, the fit from trusted and unlabelled texts divides them as one from labels would."""
    rng = np.random.default_rng(1)
    good, mixed = rng.integers(100, 256, (500, 6)), rng.integers(100, 256, (1000, 6))
    mixed[:250] = rng.integers(0, 90, (250, 6))
    model = quality.fit_non_negative(good.astype(np.uint8), mixed.astype(np.uint8), 0.75)
    values = (mixed @ (model.weights / 255) + model.shift) > 0
    assert values[:250].mean() < 0.05 and values[250:].mean() > 0.95


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score(docs, labels).join(labels, "doc_id").collect()
    mine = [r for r in rows if held(r.doc_id)]
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in mine]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_and_bad_labels_do_not_count(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["One", "two.", "three", "four,", "five"]) for _ in range(rng.randint(5, 80))) for _ in range(120)]
    texts += [" ".join(rng.choice(["#x#", "$$", "||", "%y"]) for _ in range(rng.randint(5, 80))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = [(i, 1) for i in range(0, 120, 2)]
    one = {r.doc_id: r.score for r in quality.score(docs, spark.createDataFrame(rows, "doc_id long, quality int")).collect()}
    more = [(i, 1 - q) if held(i) else (i, q) for i, q in rows] + [(i, 0) for i in range(1, 160, 2)] + [(9999, 1), (None, 1), (3, None)]
    two = {r.doc_id: r.score for r in quality.score(docs, spark.createDataFrame(more, "doc_id long, quality int")).collect()}
    assert one.keys() == two.keys() and max(abs(one[k] - two[k]) for k in one) < 1e-9
    assert np.mean([one[i] >= 0.5 for i in range(120)]) > 0.9 and np.mean([one[i] < 0.5 for i in range(120, 160)]) > 0.9


def test_odd_tables(spark, no_docs, odd_docs, wide_docs, docs):
    labels = spark.createDataFrame([(1, 1), (4, 1), (7, 0), (10, 1)], "doc_id long, quality int")
    assert quality.score(no_docs, labels).count() == 0
    none = quality.score(docs, labels.limit(0)).agg(F.max("score").alias("m"), F.count("*").alias("n")).first()
    assert none.m < 1e-9 and none.n == docs.count()
    odd = quality.score(odd_docs, labels.unionAll(spark.createDataFrame([(5, 1), (5, 1)], "doc_id long, quality int")))
    assert odd.count() == odd_docs.count()
    same = [sorted((r.doc_id, round(r.score, 9)) for r in quality.score(d, labels).collect()) for d in (docs, wide_docs)]
    assert same[0] == same[1]

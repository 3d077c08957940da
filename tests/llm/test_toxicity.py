import itertools
import random
import zlib

import numpy as np

from tallyloom.llm import toxicity
from tallyloom.llm.toxicity import chain_marginals, flat_marginals


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    for places in (1, 2, 5):
        emission, links = rng.normal(size=(1, places)) * 2, rng.normal(size=(2, 2))
        score = {}
        for path in itertools.product((0, 1), repeat=places):
            s = sum(emission[0, t] for t in range(places) if path[t]) + sum(links[a, b] for a, b in zip(path, path[1:], strict=False))
            score[path] = np.exp(s)
        z = sum(score.values())
        want = [sum(v for p, v in score.items() if p[t]) / z for t in range(places)]
        got, pairs = chain_marginals(np.pad(emission, ((0, 0), (0, 2))), np.pad(np.ones((1, places), bool), ((0, 0), (0, 2))), links, True)
        assert np.allclose(got[0, :places], want)
        counts = sum(v / z * np.array([[sum((a, b) == (i, j) for a, b in zip(p, p[1:], strict=False)) for j in (0, 1)] for i in (0, 1)]) for p, v in score.items())
        assert np.allclose(pairs, counts)


def test_blocks_change_nothing():
    rng = np.random.default_rng(6)
    links = np.array([[0.0, -2.0], [0.5, 1.0]])
    lengths = np.array([1, 63, 64, 65, 700, 2, 128, 5000])
    emission = rng.normal(size=lengths.sum()) * 3 - 2
    got = flat_marginals(emission, lengths, links)
    for i, n in enumerate(lengths):
        part = slice(lengths[:i].sum(), lengths[:i].sum() + n)
        want = chain_marginals(emission[part][None, :], np.ones((1, n), bool), links)[0]
        assert np.allclose(got[part], want, rtol=1e-9, atol=1e-12)


def labelled(n=1200, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdefghilmnoprst") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 300))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randint(1, 4)):
                bad = rng.choice(["zukfoo", "wexbar", "quz" + rng.choice(words)])
                text.insert(rng.randrange(len(text)), rng.choice([bad, bad.title() + ",", bad + "."]))
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy_and_offsets(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, truth)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i].score >= 0.5) == bool(labels[i][2]) for i in held]) >= 0.97
    for i, text, *_ in rows[:200]:
        for s in got[i].spans:
            if labels[i][2]:
                assert text[s.start : s.stop].lower()[:3] in ("zuk", "wex", "quz") or s.p < 0.9
    kept = {r.doc_id for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {i for i, r in got.items() if r.score < 0.5}


def test_held_out_rows_are_never_learned_from(spark):
    rows, labels = labelled(300)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    docs = spark.createDataFrame(rows, DOCS).repartition(2)
    models = [toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    assert np.array_equal(models[0].weights, models[1].weights) and models[0].slope == models[1].slope


def test_odd_tables(spark, odd_docs, no_docs, wide_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (5, None, None), (5, 1, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        model = toxicity.fit(odd_docs, labels)
        rows = toxicity.score(odd_docs, model).collect()
        assert len(rows) == 7 and all(0 <= r.score < 0.5 for r in rows)
    model = toxicity.fit(no_docs, none)
    assert toxicity.score(no_docs, model).count() == 0 and toxicity.keep_clean(no_docs, model).count() == 0
    out = toxicity.keep_clean(wide_docs, model)
    assert out.columns == wide_docs.columns and out.count() == wide_docs.count()


def test_long_texts_are_learned_from(spark):
    rows, labels = labelled(160, seed=8)
    rng = random.Random(9)
    plain = [w for _, text, *_ in rows[:40] for w in text.split() if w.lower()[:3] not in ("zuk", "wex", "quz")]
    filler = " ".join(rng.choice(plain) for _ in range(21_000))
    # Every text is over 100,000 characters; its own words, toxic ones among them, come last.
    long = [(i, filler + " " + text, *rest) for i, text, *rest in rows]
    docs = spark.createDataFrame(long, DOCS).repartition(4)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).select("doc_id", "score").collect()}
    assert model.slope > 0 and min(len(t) for _, t, *_ in long) > 100_000
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]) >= 0.9


def test_training_windows_stand_for_the_whole_text():
    telling = frozenset([toxicity.mark_hash("=zukfoo")])
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(11_000)]
    for toxic in (0, 1):
        short = toxicity.training_parts(1, " ".join(words[:1000]), toxic, telling)
        assert [w for part, *_ in short for w in part] == words[:1000] and {v for *_, v in short} == {1.0}
    words[10_500] = "Zukfoo!"
    parts = toxicity.training_parts(1, " ".join(words), 1, telling)
    assert len(parts) == toxicity.FIT_WINDOWS + 1
    assert np.isclose(sum(len(part) * v for part, _, v in parts), len(words))
    assert sum(v * y.sum() for _, y, v in parts) == 1
    clean = toxicity.training_parts(2, " ".join(words), 0, telling)
    assert max(words.index(part[0]) for part, *_ in clean if part[0] in words) > len(words) // 2
    assert not any(y.any() for _, y, _ in clean)


def test_weights_count_like_repeated_chains():
    rng = np.random.default_rng(11)
    chains = [([f"w{k}" for k in rng.integers(0, 30, 9)], rng.integers(0, 2, 9).astype(np.int8), 1.0) for _ in range(20)]
    a = toxicity.fit_chain([*chains, chains[0], chains[0]])
    b = toxicity.fit_chain([(*chains[0][:2], 3.0), *chains[1:]])
    assert np.allclose(a.weights, b.weights, atol=1e-4) and np.allclose(a.links, b.links) and np.isclose(a.bias, b.bias)

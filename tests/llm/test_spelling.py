import re
import zlib
from collections import Counter

import pytest

from tallyloom.llm import spelling

A = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text):
    return text.translate(str.maketrans(A, A.lower()))


def near(x, y):
    """Exactly one edit apart."""
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    if len(x) > len(y):
        x, y = y, x
    return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))


def plain(rows, min_chars, min_count, times, slip):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zA-ZÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    n = {w: c for w, c in total.items() if len(w) >= min_chars and c >= min_count}
    known = {w: [v for v in n if near(w, v)] for w in n}
    form = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in known.items() if vs}
    form = {w: f for w, f in form.items() if n[f] >= times * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(known[w]), n[form[w]] if w in form else None) for w in n}


def found(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.mark.parametrize("min_chars, min_count, times, slip", [(4, 1, 2, 7), (6, 2, 5, 199), (5, 1, 2, 3)])
def test_like_all_pairs(spark, min_chars, min_count, times, slip):
    import random

    rng = random.Random(min_chars)
    stems = ["".join(rng.choice("abcéÀß") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(80):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = stems[int(len(stems) * rng.random() ** 3)]
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "a", "bé", w[k].upper()]) + w[k + 1 :]
            words.append(w)
        rows.append((rng.choice([i, i, None, i % 5]), rng.choice([" ", "-", "1", "ł"]).join(words)))
    rows += [(1, None), (2, ""), (3, "aaaaaaa aaaaaaaa abababab babababa " * 9), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = found(spelling.variants(df, min_chars=min_chars, min_count=min_count, times=times, slip=slip))
    assert out == plain(rows, min_chars, min_count, times, slip)
    assert any(r[4] > 1 for r in out) and any(r[1] for r in out)
    assert times > 2 or any(r[1] not in (None, r[2]) for r in out)  # a chain of two


def test_hot_lookups_are_dealt_out(spark, monkeypatch):
    rows = [(i, f"abcdef{a}{b}") for i, (a, b) in enumerate((a, b) for a in "ghijklmnopqrstuvw" for b in "ghijklmnop")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(spelling, "ASKED", 20)
    assert found(spelling.variants(df, min_count=1, slip=10**12)) == plain(rows, 6, 1, 5, 10**12)


def test_held_words_are_handed_on(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    counted = {r.word: r.n for r in spelling.word_counts(docs, min_chars=5, min_count=3).collect()}
    assert counted == {w: n for w, _, _, n, _, _ in plain([(r[0], r[1]) for r in corpus], 5, 3, 10**9, 199)}


def test_pivots_share_no_character():
    rank = {a + b: i for i, (a, b) in enumerate((a, b) for a in "ab" for b in "ab")}
    for word in ("aaaaaa", "ababab", "aabbaa", "abbbba"):
        prefix = spelling.gram_prefix(word, rank)
        one, two = spelling.pivots(prefix, [5, 3, 2, 1])
        assert two[1] - one[1] >= 2 and {one, two} <= set(prefix)
        cost = lambda x, y: [5, 3, 2, 1][x[0]] + [5, 3, 2, 1][y[0]]
        assert cost(one, two) == min(cost(x, y) for x in prefix for y in prefix if y[1] - x[1] >= 2)


def test_odd_tables(spark, no_docs, odd_docs, wide_docs, docs):
    assert spelling.variants(no_docs).count() == 0
    assert found(spelling.variants(odd_docs, min_chars=4, min_count=3)) == {
        ("same", None, "same", 4, 0, None),
        ("text", None, "text", 4, 0, None),
        ("here", None, "here", 4, 0, None),
    }
    assert found(spelling.variants(wide_docs)) == found(spelling.variants(docs))
    with pytest.raises(ValueError):
        spelling.variants(docs, min_chars=3)
    with pytest.raises(ValueError):
        spelling.variants(docs, times=1)

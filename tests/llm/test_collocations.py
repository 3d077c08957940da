import random
import re
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import collocations
from tallyloom.llm.quotient import Packing

A = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain(rows, least, top, longest=4):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(str.maketrans(A, A.lower()))):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i : i + n])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, p), a in candidates.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                inside[lang, p[i : i + n]] = max(inside[lang, p[i : i + n]], a)
    out = set()
    for lang in total:
        rows = []
        for (mine, p), a in candidates.items():
            if mine != lang or 100 * inside[lang, p] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), " ".join(p), a, l, r, total[lang], score))
        out |= {(lang, rank, *row[3:]) for rank, row in enumerate(sorted(rows)[:top], 1)}
    return out


def found(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def sentences(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "aé", "Éa", "x", "data", " ", "\x1f", "big", "\x00", "bank"]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(["big data bank", "of the", *words, *words]) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\x0b", "\n", "? "])
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), text))
    return rows + [("en", None), ("en", ""), ("fr", " \n\t"), ("en", "of the big data " * 3000), ("en", "a " * 5000)]


@pytest.mark.parametrize("least, block_bytes, chunk_keys", [(3, 400, 20), (30, 1 << 20, 1 << 18), (1, 5000, 300)])
def test_like_plain_counts(spark, least, block_bytes, chunk_keys):
    rows = sentences(least, 150)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    out = found(collocations.mine(df, least=least, top=40, block_bytes=block_bytes, chunk_keys=chunk_keys))
    assert out == plain(rows, least, 40) and len(out) > 4


def test_first_of_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANKED", 25)
    rows = sentences(9, 100)
    assert found(collocations.mine(spark.createDataFrame(rows, "lang string, text string"), least=2, top=10)) == plain(rows, 2, 10)


@pytest.mark.parametrize("n, bits, chunk_bits", [(2, 1, 0), (2, 9, 3), (3, 20, 5), (4, 16, 8), (4, 32, 10), (2, 32, 4), (3, 32, 12), (4, 17, 2)])
def test_filters_lose_nothing(n, bits, chunk_bits):
    rng = np.random.default_rng(bits)
    packing = Packing(n, bits, chunk_bits)
    ids = [rng.integers(0, 2**bits, 4000) for _ in range(n)]
    ids = [np.concatenate([x, x[:500]]) for x in ids]
    halves = packing.permuted(ids)
    for x, y in zip(ids, packing.restored(*halves), strict=True):
        assert (x == y).all()
    a, b, counts, at = packing.distinct(*halves)
    want = Counter(zip(*(x.tolist() for x in ids), strict=True))
    assert dict(zip(zip(*(x.tolist() for x in packing.restored(a, b)), strict=True), counts.tolist(), strict=True)) == want
    counts = counts * rng.integers(1, 1000, len(counts))
    chunks = packing.chunk_of(a)
    assert (np.diff(chunks) >= 0).all()
    for chunk in np.unique(chunks):
        mine = chunks == chunk
        back = packing.decoded(int(chunk), packing.encoded(a[mine], b[mine], counts[mine]))
        assert all((x == y).all() for x, y in zip(back, (a[mine], b[mine], counts[mine]), strict=True))


def test_chunks_are_even():
    packing = Packing(2, 16, 6)
    a, _, _, _ = packing.distinct(*packing.permuted([np.arange(20000) % 200, np.arange(20000) // 200]))
    sizes = np.bincount(packing.chunk_of(a), minlength=64)
    assert sizes.max() < 2 * sizes.mean()


def test_ids_beyond_32_bits_are_refused():
    with pytest.raises(ValueError):
        Packing(4, 33, 0)


def test_scores_are_exact(spark):
    big = 7_000_000_000_000_000
    found_ = spark.createDataFrame([([1], big + 3), ([2], big + 1), ([1, 2], big - 1)], "ids array<long>, f long")
    row = collocations.scored(found_).first()
    assert row.score == 2000000 * (big - 1) // (2 * big + 4)


def test_odd_tables(spark, no_docs, odd_docs, wide_docs, docs, corpus):
    assert collocations.mine(no_docs).count() == 0
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert found(collocations.mine(odd_docs, least=2)) == plain(rows, 2, 2000)
    rows = [(r[2], r[1]) for r in corpus]
    assert found(collocations.mine(wide_docs, least=3)) == plain(rows, 3, 2000)

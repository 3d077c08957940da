import zlib
from collections import defaultdict

import numpy as np
import pytest

from tallyloom.llm import kd_shards, packing, pieces, queries

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    return tokenizers.Tokenizer.from_file(queries.vocabulary("json"))


def test_fast_ids_equal_the_tokenizer(tokenizer, corpus):
    encode = packing.byte_bpe_encoder(queries.vocabulary("json"), queries.vocabulary("ranks"))
    odd = ["", " ", "\n\n  x", "<|endoftext|> a", "<|endoftext|>", "x <|endoftext|><|endoftext|>\n<|endoftext", "a<|endoftext|>" + " " * 300, "don't 12345 ١٢٣ 😀 é́ ​ 　 x", "a" * 3000, " " * 500 + "b", "\x00\x7f﻿", "İſK"]
    for text in [*odd, *[t for _, t, *_ in corpus if t]]:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_cut_covers_and_wastes_little():
    for n in [*range(1, 3000), 100_000]:
        parts = packing.cut(n)
        assert sum(parts) == n and all(0 < p <= 1024 and packing.waste(p) <= packing.MAX_WASTE for p in parts)


def check_packing(rows, texts, tokenizer, capacity=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert set(by_doc) == set(texts)
    for piece in by_sequence.values():
        at = 0
        for r in sorted(piece, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_sequence


def test_packing_is_whole_and_full(spark, wide_docs, corpus, tokenizer):
    more = [(10_000, "one <|endoftext|> two"), (10_001, "<|endoftext|>" * 1500)]
    both = wide_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = packing.pack(both, queries.byte_bpe()).collect()
    sequences = check_packing(rows, {d: t for d, t, *_ in corpus} | dict(more), tokenizer)
    assert sum(r.length for r in rows) / 1024 / len(sequences) > 0.9


def test_classes_hold_a_fixed_number(spark, tokenizer):
    # Many short documents over many batches: whole bins of one class, and one open bin a class at the end.
    texts = {i: "word " * (i % 7 + 1) for i in range(5000)}
    frame = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(7)
    rows = packing.pack(frame, queries.byte_bpe()).collect()
    sequences = check_packing(rows, texts, tokenizer)
    full = [s for k, s in sequences.items() if k < 1 << 62]
    for s in full:
        k = 1024 // max(r.length for r in s)
        assert len(s) == 1024 // min(r.length for r in s) or len(s) == k
    assert any(k >= 1 << 61 for k in sequences)
    assert sum(r.length for r in rows) / 1024 / len(sequences) > 0.9


def test_packing_of_odd_tables(odd_docs, no_docs):
    rows = packing.pack(odd_docs, queries.byte_bpe()).collect()
    assert len(rows) == 7 and sum(r.doc_id is None for r in rows) == 2
    assert packing.pack(no_docs, queries.byte_bpe()).count() == 0


@pytest.fixture(scope="module")
def vocabulary():
    pytest.importorskip("sentencepiece")
    return pieces.Vocabulary(queries.vocabulary("pieces"))


def plain_lattice(vocabulary, word):
    """All segmentations of a short word with their weights, from the model file itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=queries.vocabulary("pieces"))
    rank, weight = 0, {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            rank += 1
            weight[model.id_to_piece(i)] = (i, (rank + pieces.RANK_SHIFT) ** -pieces.TEMPERATURE)
    text = word.replace(" ", "▁")

    def ways(at):
        if at == len(text):
            return [((), 1.0)]
        out = []
        for stop in range(at + 1, len(text) + 1):
            if text[at:stop] in weight:
                i, w = weight[text[at:stop]]
                out += [((i, *rest), w * v) for rest, v in ways(stop)]
        return out

    return ways(0)


def test_sampled_shares_follow_the_lattice(vocabulary):
    found = plain_lattice(vocabulary, " theres")
    total = sum(w for _, w in found)
    n = 20_000
    ids = pieces.encode_batch(pieces.Lattices(vocabulary), list(range(n)), ["theres"] * n)
    seen = defaultdict(int)
    for x in ids:
        seen[tuple(x.tolist())] += 1
    assert set(seen) <= {s for s, _ in found}
    for s, w in found:
        share = w / total
        assert abs(seen[s] / n - share) < 4 * (share * (1 - share) / n) ** 0.5 + 2 / n


def test_long_words_are_cut_and_walked_alike(vocabulary, monkeypatch):
    rng = np.random.default_rng(2)
    texts = ["abcde" * 700, "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 5000))), "".join(map(chr, rng.integers(97, 123, 3000))), "there " * 50]
    whole = pieces.encode_batch(pieces.Lattices(vocabulary), [1, 2, 3, 4], texts)
    assert [pieces.decode(vocabulary, x) for x in whole] == texts
    monkeypatch.setattr(pieces, "STEPS", 3)
    other = pieces.encode_batch(pieces.Lattices(vocabulary), [1, 2, 3, 4], texts)
    assert all(np.array_equal(a, b) for a, b in zip(whole, other, strict=True))


def test_round_trip_and_reproducible(spark, docs, odd_docs, no_docs, corpus, vocabulary):
    odd = ["▁", " ▁ a▁", "\n\n \n", "   ", "😀\x00\x01", "a" * 5000, "é" * 50 + "́", "tab\tx", "İ中文字", " lead and trail "]
    first = pieces.encode_batch(pieces.Lattices(vocabulary), list(range(len(odd))), odd)
    assert [pieces.decode(vocabulary, x) for x in first] == odd
    alone = [pieces.encode_batch(pieces.Lattices(vocabulary), [k], [t])[0] for k, t in enumerate(odd)]
    assert all(np.array_equal(a, b) for a, b in zip(first, alone, strict=True))
    encoded = pieces.encode(docs, queries.vocabulary("pieces"))
    rows = {r.doc_id: r for r in encoded.collect()}
    again = {r.doc_id: r for r in pieces.encode(docs.repartition(2), queries.vocabulary("pieces")).collect()}
    assert rows == again and all(r.lossless for r in rows.values())
    back = {r.doc_id: r.text for r in pieces.decode_ids(encoded, queries.vocabulary("pieces")).collect()}
    assert back == {d: t or "" for d, t, *_ in corpus}
    assert rows[corpus[60][0]].ids != rows[corpus[60 - 60][0]].ids  # equal texts, other keys
    assert pieces.encode(odd_docs, queries.vocabulary("pieces")).count() == 7
    assert pieces.encode(no_docs, queries.vocabulary("pieces")).count() == 0


def check_shards(rows, texts, shards):
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(0 <= s < shards for s in size)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return [size[s] for s in range(shards)]


def test_shards_are_even_and_slots_have_no_gaps(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "x" * int(rng.integers(0, 300)), f"l{i % 2}", f"src{int(rng.integers(0, 5))}" if i % 3 else "hot", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    for shards in (8, 5, 1):
        out = kd_shards.with_slots(kd_shards.assign(docs, shards=shards)).collect()
        sizes = check_shards(out, rows, shards)
        assert len(out) == 3000 and max(sizes) - min(sizes) <= 0.02 * sum(sizes) / shards
        for r in out[:50]:
            assert r.size == len(rows[r.doc_id][1].encode()) + 1 and r.crc == zlib.crc32(rows[r.doc_id][1].encode())


def test_copies_and_equal_metadata_can_be_divided(spark, monkeypatch):
    monkeypatch.setattr(kd_shards, "SLOT_ROWS", 100)
    rows = [(i, "copy", "en", "a", 4) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    sizes = check_shards(kd_shards.with_slots(kd_shards.assign(docs, target_bytes=2500)).collect(), rows, 4)
    assert max(sizes) - min(sizes) <= 10


def test_copies_share_a_shard_wherever_they_come_from(spark):
    rng = np.random.default_rng(5)
    start = "https://example.org/a/very/long/common/beginning/"
    rows = [
        (i, f"text {i // 6} " + "x" * int(rng.integers(0, 90) if i % 6 else 40), f"l{int(rng.integers(0, 4))}", f"{start}{int(rng.integers(0, 40)):02}", 0)
        for i in range(2400)
    ]
    rows = [(i, rows[i - i % 6][1], lang, source, 0) for i, _, lang, source, _ in rows]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    found = [
        {r.doc_id: (r.shard, r.slot) for r in kd_shards.with_slots(kd_shards.assign(spark.createDataFrame(rows[::step], kind).repartition(n), shards=8)).collect()}
        for n, step in ((3, 1), (7, -1))
    ]
    assert found[0] == found[1]
    shards = defaultdict(set)
    for i, text, *_ in rows:
        shards[text].add(found[0][i][0])
    assert len(shards) == 400 and sum(len(s) > 1 for s in shards.values()) <= 7


def test_ranks_tell_long_values_apart(spark, monkeypatch):
    monkeypatch.setattr(kd_shards, "SLOT_ROWS", 10)
    values = [f"https://example.org/{i:03}" for i in range(60)] + [""]
    frame = spark.createDataFrame([(v,) for v in values * 3], "source string")
    got = {r.source: r.raw_source for r in kd_shards._ranked(frame, "source").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values))}


def test_shards_of_odd_tables(odd_docs, no_docs, wide_docs):
    out = kd_shards.with_slots(kd_shards.assign(odd_docs, shards=8)).collect()
    assert len(out) == 7 and sorted(r.size for r in out)[:2] == [1, 1]
    assert kd_shards.with_slots(kd_shards.assign(no_docs, shards=8)).count() == 0
    assert kd_shards.assign(wide_docs, shards=2).count() == wide_docs.count()
    with pytest.raises(ValueError):
        kd_shards.assign(no_docs, shards=kd_shards.MAX_SHARDS + 1)

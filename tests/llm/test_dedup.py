import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tallyloom.llm import bloom_dedup, common, simhash
from tallyloom.session import fresh_folder


def lowered(t):
    return (t or "").translate({i: i + 32 for i in range(65, 91)})


def test_copies_match_plain_grouping(docs, corpus):
    groups = defaultdict(list)
    for doc, text, *_ in corpus:
        groups[lowered(text)].append(doc)
    got = {r.doc_id: r for r in bloom_dedup.copies(docs).collect()}
    assert len(got) == len(corpus)
    for doc, text, *_ in corpus:
        mine = groups[lowered(text)]
        r = got[doc]
        assert (r.keep_id, r.group_size, r.kept) == (max(mine), len(mine), doc == max(mine))
        assert r.text_sha256 == hashlib.sha256(lowered(text).encode()).hexdigest()


def test_unique_rows_are_not_shuffled(docs):
    rows = docs.select(bloom_dedup.text_digest(F.col("text")).alias("digest"))
    bitmaps, blocks = bloom_dedup.repeat_filter(rows)
    flagged = bloom_dedup.flag_repeats(rows, "digest", bitmaps, blocks, "maybe")
    counts = {r.digest: r["n"] for r in rows.groupBy("digest").agg(F.count("*").alias("n")).collect()}
    seen = [(counts[r.digest], r.maybe) for r in flagged.collect()]
    assert all(maybe for n, maybe in seen if n > 1)
    assert sum(maybe for n, maybe in seen if n == 1) <= 0.1 * len(seen)
    plan = flagged.where("not maybe")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def exchanges(node):
    """Shuffles of a plan that is not adaptive: column names that go through, and the text of what lies below."""
    below = [node.children().apply(i) for i in range(node.children().size())]
    if node.nodeName() == "Exchange" and "Shuffle" in node.getClass().getSimpleName():
        out = node.output()
        yield [out.apply(i).name() for i in range(out.size())], below[0].toString()
    for child in below:
        yield from exchanges(child)


@pytest.mark.parametrize("bound", [32768, 1])
def test_whole_plans_shuffle_possible_copies_only(spark, docs, monkeypatch, bound):
    monkeypatch.setattr(bloom_dedup, "BROADCAST_BLOCKS", bound)
    written = []
    monkeypatch.setattr(bloom_dedup, "stored", lambda df, label: written.append((label, df)) or common.stored(df, label))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = docs.sparkSession.read.schema(docs.schema).parquet(written_copy(docs))
        results = [("copies", bloom_dedup.copies(plain)), ("drop_copies", bloom_dedup.drop_copies(plain))]
        seen = 0
        for label, df in [*written, *results]:
            for columns, below in exchanges(df._jdf.queryExecution().executedPlan()):
                seen += 1
                # Counts of slots and bits, or rows that the broadcast filter let through.
                narrow = set(columns) <= {"slot", "block", "bitmap", "count"}
                assert narrow or "BroadcastHashJoin" in below, (label, columns)
                assert "text" not in columns or "BroadcastHashJoin" in below, (label, columns)
        assert seen
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def written_copy(df):
    path = fresh_folder(df.sparkSession, "test-docs")
    df.write.parquet(path)
    return path


def test_repeated_rows_and_null_ids_among_many_copies(spark):
    rows = [(i, f"Text {i % 40}" if i % 3 else "HOT", "en", "a", 5) for i in range(600)] + [(None, "text 1", "en", "a", 5)] * 3
    rows += [(599, "hot", "en", "a", 5), (None, "alone", None, None, None), (None, "alone", None, None, None), (700, "single", "en", "a", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    best = {}
    for doc, text, *_ in rows:
        best.setdefault(lowered(text), []).append(doc)
    want = sorted((t, max((d for d in ids if d is not None), default=None)) for t, ids in best.items())
    got = [(lowered(r.text), r.doc_id) for r in bloom_dedup.drop_copies(frame).collect()]
    assert sorted(got) == want


def test_large_filters_meet_rows_by_shuffle(docs, monkeypatch):
    want = {tuple(r) for r in bloom_dedup.copies(docs).collect()}
    monkeypatch.setattr(bloom_dedup, "BROADCAST_BLOCKS", 0)
    assert {tuple(r) for r in bloom_dedup.copies(docs).collect()} == want


def test_drop_copies_keeps_columns_and_one_row_per_text(wide_docs, corpus):
    out = bloom_dedup.drop_copies(wide_docs)
    assert out.columns == wide_docs.columns
    best = {}
    for doc, text, *_ in corpus:
        best[lowered(text)] = max(doc, best.get(lowered(text), doc))
    assert sorted(r.doc_id for r in out.collect()) == sorted(best.values())


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = [tuple(r)[:4] for r in bloom_dedup.copies(odd_docs).collect()]
    assert len(rows) == 7
    assert rows.count((5, 5, 4, True)) == 2 and (None, 5, 4, False) in rows and (2, 5, 4, False) in rows
    assert (None, 9, 2, False) in rows
    assert sorted((r.doc_id, r.text) for r in bloom_dedup.drop_copies(odd_docs).collect()) == [(5, "another"), (5, "same text here"), (9, "")]
    assert bloom_dedup.copies(no_docs).count() == 0 and bloom_dedup.drop_copies(no_docs).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(ids, prints):
    p = np.array(prints, np.uint64)
    comp = list(range(len(ids)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, j in zip(*np.nonzero(np.bitwise_count(p[:, None] ^ p[None, :]) <= 3), strict=True):
        comp[find(i)] = find(j)
    low = {}
    for i, doc in enumerate(ids):
        low[find(i)] = min(doc, low.get(find(i), doc))
    return {doc: low[find(i)] for i, doc in enumerate(ids)}


def test_simhash_groups_match_all_pairs(docs, corpus):
    prints = {doc: plain_fingerprint(text) for doc, text, *_ in corpus}
    want = plain_components(list(prints), list(prints.values()))
    got = simhash.groups(docs).collect()
    assert len(got) == len(corpus)
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}" and r.component_id == want[r.doc_id]
    # The twelve variants of one text are linked.
    assert max(np.unique(list(want.values()), return_counts=True)[1]) >= 12


def test_vantage_point_trees_lose_no_link(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    near = [c ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, k, dtype=np.uint64)) for c in centres for k in (1, 2, 3, 4)]
    hot = [centres[0] ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(40) for b in range(a)]
    prints = np.unique(np.array([*centres, *near, *hot], np.uint64))
    want = plain_components(prints.view(np.int64).tolist(), prints)
    frame = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    linked = {r.node: r.component for r in common.components(simhash.links(frame)).collect()}
    assert {x: linked.get(x, x) for x in want} == want


def test_the_shard_tree_grows_with_the_shards():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2)
    nodes = simhash._regions(prints[:16_384], 8192)
    shard, _, home = simhash._deal(nodes, prints[-2000:])
    assert home.sum() == 2000 and len(nodes) > 4096
    own = simhash._deal(nodes, prints)
    filled = np.unique(own[0][own[2]], return_counts=True)[1]
    assert len(filled) > 4096 and filled.max() < 16 * filled.mean()


def test_near_copies_leave_by_their_ids(docs):
    plan = simhash.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_a_long_text_is_fingerprinted_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 128)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def test_keep_one_and_odd_tables(docs, wide_docs, corpus, odd_docs, no_docs):
    prints = {doc: plain_fingerprint(text) for doc, text, *_ in corpus}
    want = plain_components(list(prints), list(prints.values()))
    out = simhash.keep_one(wide_docs)
    assert out.columns == wide_docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(want.values()))
    rows = simhash.groups(odd_docs).collect()
    assert len(rows) == 7 and {r.component_id for r in rows if r.doc_id is None} == {2, 9}
    assert simhash.groups(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(50)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0

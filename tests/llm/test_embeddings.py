import numpy as np
import pyarrow as pa

from tallyloom.llm import hnsw
from tallyloom.llm.common import roots

SCHEMA = "vec_id long, embedding array<float>, label int, node string, copies string"


def plain(rows):
    """Links, smallest reachable id and counts by brute force."""
    ok = {}
    for at, (i, v, label) in enumerate(rows):
        if v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[at] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = {at: [] for at in range(len(rows))}
    for a in ok:
        for b in ok:
            if a != b and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.93:
                links[a].append(b)
    comp = {}
    for a in links:
        if a not in comp:
            group, todo = {a}, [a]
            while todo:
                for b in links[todo.pop()]:
                    if b not in group:
                        group.add(b)
                        todo.append(b)
            low = min(rows[b][0] for b in group)
            comp.update({b: low for b in group})
    return [(rows[a][0], len(links[a]), comp[a], rows[a][0] == comp[a]) for a in links]


def vectors(rng, n, dim=16):
    out = []
    for i in range(n):
        centre = rng.normal(size=dim) if i % 10 == 0 else centre  # noqa: F821
        out.append((centre + rng.normal(size=dim) * rng.choice([0.02, 0.2, 0.35])).astype(np.float32).tolist())
    return out


def run(spark, rows):
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hnsw.near_copies(frame).collect())


def test_links_and_components_match_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(1000 - i, v, i % 3) for i, v in enumerate(vectors(rng, 400))]
    rows += [(2000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(30)]  # copies of a few vectors
    rows += [(3000, [0.0] * 16, 0), (3001, None, 0), (3002, [float("nan")] * 16, 1), (3003, [None] * 16, 1), (3004, rows[0][1], None)]
    rows += [(3005, [], 0), (3006, [1.0, 2.0], 0), (3007, [2.0, 4.0], 0), (3008, [float("inf")] + [1.0] * 15, 0)]
    assert run(spark, rows) == sorted(plain(rows))


def test_links_across_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 50)
    rng = np.random.default_rng(2)
    rows = [(i, v, 0) for i, v in enumerate(vectors(rng, 300))]
    assert run(spark, rows) == sorted(plain(rows))


def test_a_dense_group_widens_the_beam():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=32) + 0.1 * rng.normal(size=(600, 32)), rng.normal(size=(1400, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shard = hnsw.Shard(np.arange(2000), x)
    shard.audit(x)
    found = len(shard.links(x)[0])
    assert found >= 0.99 * (x @ x.T >= 0.93).sum()


def test_a_scanned_shard_counts_and_unites_all_links(monkeypatch):
    monkeypatch.setattr(hnsw, "BATCH", 100)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=32) + 0.1 * rng.normal(size=(300, 32)), np.repeat(rng.normal(size=(150, 32)), 2, 0)])
    x[300:] += 0.05 * rng.normal(size=(300, 32))
    ids, copies = rng.permutation(900)[:600].astype(np.int64), rng.integers(1, 4, 600)
    columns = [["a"] * 1200, [32] * 1200, [0] * 1200, np.repeat([0, 1], 600), np.tile(ids, 2), np.tile(copies, 2), np.tile(x, (2, 1)).tolist()]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=list("abcdefg"))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & ~np.eye(600, dtype=bool)
    got, a, b = dict.fromkeys(ids.tolist(), 0), [], []
    for out in hnsw._answer(iter([batch])):
        for node, root, n in zip(*(c.to_pylist() for c in out.columns), strict=True):
            got[node] += n
            a.append(node)
            b.append(root)
    assert [got[i] for i in ids.tolist()] == (near @ copies).tolist()
    q, p = np.nonzero(near)
    want = dict(zip(*(v.tolist() for v in roots(ids[q], ids[p])), strict=True))
    have = dict(zip(*(v.tolist() for v in roots(np.array(a), np.array(b))), strict=True))
    assert {k: have.get(k, k) for k in want} == want


def test_recall_on_ordinary_vectors_without_scan():
    rng = np.random.default_rng(5)
    x = np.array(vectors(rng, 3000, 64), float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shard = hnsw.Shard(np.arange(3000), x)
    shard.audit(x)
    assert not shard.scan
    q, p = shard.links(x)
    truth = (x @ x.T >= 0.93).sum()
    assert 0.9 * truth <= len(q) <= truth


def test_empty_and_repeated(spark):
    assert hnsw.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0
    v = [1.0] + [0.0] * 15
    assert run(spark, [(1, v, 0), (1, v, 0)]) == [(1, 1, 1, True), (1, 1, 1, True)]
    rows = hnsw.near_copies(spark.createDataFrame([(None, v, 0, "", ""), (4, v, 0, "", "")], SCHEMA)).collect()
    assert {tuple(r) for r in rows} == {(None, 0, None, False), (4, 0, 4, True)}


def test_links_of_small_groups_count_in_the_audit():
    rng = np.random.default_rng(12)
    pairs = np.repeat(rng.normal(size=(60, 32)), 2, axis=0) + 0.01 * rng.normal(size=(120, 32))
    x = np.concatenate([rng.normal(size=32) + 0.05 * rng.normal(size=(1500, 32)), pairs])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(len(x))
    shard = hnsw.Shard(ids, x)
    found = shard.graph.candidates

    def narrow(q, width):
        """A narrow beam loses every link of the small groups but those to the vector itself."""
        a, b = found(q, width)
        keep = (b < 1500) | (np.einsum("ij,ij->i", q[a], x[b]) > 1 - 1e-12) | (width > 2 * hnsw.BEAM)
        return a[keep], b[keep]

    shard.graph.candidates = narrow
    shard.audit(x, ids)
    assert shard.width > 2 * hnsw.BEAM or shard.scan
    q, p = shard.links(x[1500:])
    assert set(range(120)) <= set(q[p != q + 1500])


def test_the_audit_waits_for_queries(monkeypatch):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 8))
    asked, audit = [], hnsw.Shard.audit
    monkeypatch.setattr(hnsw.Shard, "audit", lambda self, queries, *ids: (asked.append(len(queries)), audit(self, queries, *ids))[1])

    def batch(key, role, rows):
        n = len(rows)
        columns = [[key] * n, [8] * n, [0] * n, [role] * n, list(rows), [1] * n, x[rows].tolist()]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["label", "dim", "shard", "role", "node", "copies", "vector"])

    every = np.arange(300)
    batches = [batch(k, r, part) for k in ("a", "b") for r, part in ((0, every), (1, every[:1]), (1, every[1:]))]
    list(hnsw._answer(iter(batches)))
    assert asked == [300, 300]

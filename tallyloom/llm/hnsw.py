"""Embedding near-dedup: a hierarchical navigable small-world graph per shard, queried by every vector.

Only vectors with equal labels and equal length are compared. Identical vectors are folded into one with a
count. Each label is dealt by a hash into shards of about SHARD_ROWS vectors; a task builds the graph of one
shard and answers the queries of all the label's vectors, streamed past it, so links across shards are found
as well. A query keeps a beam; if its whole beam lies above the threshold, the beam is made WIDER times as wide. An audit
waits for the first GATHER queries of the label (in hash order; all, if there are fewer) and counts their
links to other vectors by brute force over the shard. AUDITS of those with at most BEAM links and AUDITS of those with
more are asked; while the mean recall of the queries of either sort is below AUDIT_RECALL, the beam of all
queries is doubled, up to the size of the shard, and beyond that the shard is scanned. A shard where one of
the gathered queries is linked to more than 1/DENSE of it is scanned at once, in exact matrix blocks: a beam that holds so much of a graph
costs more than that. Where none of the
gathered queries has a link, there is nothing to compare and the beam stays. Every candidate is verified by its cosine in double precision, so no false link is reported.

A batch of queries returns, per vector, its number of links and a star over each linked group, not its
pairs. Components come from those stars.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing,
nor do rows with a null label; a row with a null vec_id has no links and no component; rows that repeat id
and vector count as vectors of their own (so they link); vec_id names a node: rows that share it and differ
in vector share a component. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import components, roots

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE = 0.93
SHARD_ROWS = 8192
LINKS = 16  # neighbours per node in upper layers; twice as many in the lowest
BUILD_BEAM = 48
BEAM = 32
GATHER = 4096  # queries that are held back for the audit
AUDITS = 128
AUDIT_RECALL = 0.995
WIDER = 2
DENSE = 16  # a query linked to more than this part of a shard calls for a scan
PAIRS = 1 << 16
EXPAND = 4  # beam entries expanded at a time
BATCH = 512
MARGIN = 1e-4  # single precision is used for walking only


class Graph:
    """A small-world graph over unit vectors, built and searched for many vectors at once."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        """``vectors``: unit length, double precision."""
        self.exact = vectors
        self.x = vectors.astype(np.float32)
        n = len(vectors)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 5)
        order = np.argsort(-level, kind="stable")  # upper layers first, so that their nodes are entries for the rest
        self.level, self.entry = level, int(order[0]) if n else -1
        self.layers = [np.full((n, LINKS * (2 if lev == 0 else 1)), -1, np.int32) for lev in range(int(level.max(initial=0)) + 1)]
        done = 1
        while done < n:
            # Batches grow with the graph, so each finds enough of it to link to.
            size = min(BATCH, max(1, done // 4), n - done)
            self._insert(order[done : done + size])
            done += size
        self.apart = np.flatnonzero(~self._reached())

    def _reached(self) -> np.ndarray:
        """Which nodes a walk over the lowest layer can come to; a few may have lost all links to them."""
        seen = np.zeros(len(self.x), bool)
        front = np.array([self.entry] if len(self.x) else [], np.int64)
        while len(front):
            seen[front] = True
            near = np.unique(self.layers[0][front])
            front = near[(near >= 0) & ~seen[near]]
        return seen

    def _insert(self, new: np.ndarray) -> None:
        at = np.full((len(new), 1), self.entry, np.int64)
        for lev in range(len(self.layers) - 1, -1, -1):
            ids, sims = self._beam(self.x[new], at, BUILD_BEAM if lev <= self.level[new].max() else 1, lev)
            at = ids[:, :8]
            mine = np.flatnonzero(self.level[new] >= lev)
            if len(mine):
                # Members of the batch can be each other's nearest.
                among = self.x[new[mine]] @ self.x[new[mine]].T
                np.fill_diagonal(among, -2.0)
                self._connect(new[mine], np.concatenate([ids[mine], np.tile(new[mine], (len(mine), 1))], axis=1), np.concatenate([sims[mine], among], axis=1), lev)

    def _connect(self, new: np.ndarray, ids: np.ndarray, sims: np.ndarray, lev: int) -> None:
        width = self.layers[lev].shape[1]
        sims = np.where(ids < 0, -2.0, sims)
        keep = min(width // 2, ids.shape[1])
        top = np.argpartition(-sims, keep - 1, axis=1)[:, :keep]
        rows = np.arange(len(new))[:, None]
        chosen = np.where(sims[rows, top] > -2.0, ids[rows, top], -1)
        self.layers[lev][new, : chosen.shape[1]] = chosen
        # Links back; a full node keeps its nearest neighbours, and its oldest one as a way out of a dense group.
        src, dst = np.repeat(new, chosen.shape[1]), chosen.ravel()
        ok = dst >= 0
        src, dst = src[ok], dst[ok]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        starts = np.flatnonzero(np.concatenate([[True], dst[1:] != dst[:-1]])) if len(dst) else []
        for a, b in zip(starts, [*starts[1:], len(dst)], strict=True):
            node = dst[a]
            old = self.layers[lev][node]
            every = np.unique(np.concatenate([old[old >= 0], src[a:b]]))
            if len(every) > width:
                near = self.x[every] @ self.x[node]
                picked = every[np.argpartition(-near, width - 1)[: width - 2]]
                # Two places go to the least similar ones, which lead elsewhere.
                rest = np.setdiff1d(every, picked)
                far = rest[np.argsort(self.x[rest] @ self.x[node])[:2]]
                every = np.concatenate([picked, far])
            row = np.full(width, -1, np.int32)
            row[: len(every)] = every
            self.layers[lev][node] = row

    def _beam(self, q: np.ndarray, start: np.ndarray, width: int, lev: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and similarities of the beams, best first; -1 where a beam is not full."""
        layer, b, n = self.layers[lev], len(q), len(self.x)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, n + 1), bool)
        seen[:, n] = True  # place -1
        ids = np.full((b, max(width, start.shape[1])), -1, np.int64)
        ids[:, : start.shape[1]] = start
        seen[rows, start] = True
        sims = np.where(ids >= 0, np.einsum("bkd,bd->bk", self.x[ids[:, : start.shape[1]]], q) if ids.shape[1] == start.shape[1] else np.pad(np.einsum("bkd,bd->bk", self.x[start], q), ((0, 0), (0, ids.shape[1] - start.shape[1]))), -2.0).astype(np.float32)
        opened = ids < 0
        live = np.arange(b)
        while len(live):
            rank = np.where(opened[live], -3.0, sims[live])
            k = min(EXPAND, rank.shape[1])
            best = np.argpartition(-rank, k - 1, axis=1)[:, :k]
            usable = np.take_along_axis(rank, best, 1) > -2.5
            live, best, usable = live[usable.any(1)], best[usable.any(1)], usable[usable.any(1)]
            if not len(live):
                break
            r = live[:, None]
            source = np.where(usable, ids[r, best], -1)
            opened[r, best] = True
            near = np.where(source[:, :, None] >= 0, layer[source], -1).reshape(len(live), -1)
            near = np.where(seen[r, near], -1, near)
            # The same neighbour can come from two sources: keep one.
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            seen[r, near] = True
            wide = int((near >= 0).sum(1).max(initial=0))
            if not wide:
                continue
            near = -np.partition(-near, wide - 1, axis=1)[:, :wide]
            s = np.where(near >= 0, np.einsum("bkd,bd->bk", self.x[near], q[live]), -2.0).astype(np.float32)
            ids_, sims_, opened_ = (np.concatenate(x, axis=1) for x in ((ids[live], near), (sims[live], s), (opened[live], near < 0)))
            top = np.argpartition(-sims_, ids.shape[1] - 1, axis=1)[:, : ids.shape[1]]
            ids[live], sims[live], opened[live] = (np.take_along_axis(x, top, 1) for x in (ids_, sims_, opened_))
            ids[sims <= -2.0] = -1
        order = np.argsort(-sims, axis=1, kind="stable")[:, : max(width, 1)]
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def candidates(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs that may lie above the threshold; beams that are full of such pairs are widened."""
        out_q, out_p = [], []
        todo = np.arange(len(q))
        while len(todo):
            again = []
            # Memory of the visited marks stays bounded whatever the beam.
            for i in range(0, len(todo), BATCH):
                part = todo[i : i + BATCH]
                at = np.full((len(part), 1), self.entry, np.int64)
                for lev in range(len(self.layers) - 1, 0, -1):
                    at = self._beam(q[part], at, 4, lev)[0]
                    at = np.where(at < 0, self.entry, at)[:, :1]
                ids, sims = self._beam(q[part], at, width, 0)
                hit = sims >= COSINE - MARGIN
                full = hit[:, -1] & (width < len(self.x))
                again.append(part[full])
                a, b = np.nonzero(hit & ~full[:, None])
                out_q.append(part[a])
                out_p.append(ids[a, b])
            todo = np.concatenate(again)
            width = min(WIDER * width, max(1, len(self.x)))
        if len(self.apart):  # what no walk reaches is compared directly
            a, b = np.nonzero(q @ self.x[self.apart].T >= COSINE - MARGIN)
            out_q.append(a)
            out_p.append(self.apart[b])
        return np.concatenate(out_q), np.concatenate(out_p)


def _cosine_pairs(points: np.ndarray, queries: np.ndarray, q: np.ndarray, p: np.ndarray):
    """Keep the pairs whose cosine in double precision reaches the threshold."""
    keep = np.empty(len(q), bool)
    for i in range(0, len(q), PAIRS):  # two vectors a pair, so a slice at a time
        part = slice(i, i + PAIRS)
        keep[part] = np.einsum("ij,ij->i", queries[q[part]], points[p[part]]) >= COSINE
    return q[keep], p[keep]


def _linked_block(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Which point each query is linked to, as a matrix. Cosines within rounding of the threshold are taken pair by pair."""
    cosine = queries @ points.T
    near = cosine >= COSINE
    q, p = np.nonzero(np.abs(cosine - COSINE) < 1e-9)
    near[q, p] = False
    q, p = _cosine_pairs(points, queries, q, p)
    near[q, p] = True
    return near


def _least_reached(near: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column of a matrix of links reaches within it."""
    none = np.iinfo(np.int64).max
    while True:
        low_rows = np.minimum(rows, np.where(near, columns, none).min(1, initial=none))
        low_columns = np.minimum(columns, np.where(near, low_rows[:, None], none).min(0, initial=none))
        if np.array_equal(rows, low_rows) and np.array_equal(columns, low_columns):
            return rows, columns
        rows, columns = low_rows, low_columns


class Shard:
    """The index of one shard: graph, and the beam that the audits settled on; a scan where links are dense."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.width, self.scan = min(BEAM, len(ids)), False

    @cached_property
    def graph(self) -> Graph:
        """Built when it is first walked."""
        return Graph(self.vectors)

    def audit(self, queries: np.ndarray, ids: np.ndarray | None = None) -> None:
        """Widen the beam until the audited queries find their links; ``ids``: their nodes, so that a link of a
        vector to itself does not count."""
        step = max(1, len(queries) // GATHER)
        some, own = queries[::step], None if ids is None else ids[::step]
        truth = np.zeros(len(some), np.int64)
        for i in range(0, len(some), BATCH):
            near = some[i : i + BATCH] @ self.vectors.T >= COSINE
            if own is not None:
                near &= own[i : i + BATCH, None] != self.ids
            truth[i : i + BATCH] = near.sum(1)
        if truth.max(initial=0) > max(BEAM, len(self.ids) // DENSE):
            self.scan = True  # beams would have to hold a good part of the shard
            return
        sorts = [np.flatnonzero((truth > 0) & (truth <= BEAM))[:AUDITS], np.flatnonzero(truth > BEAM)[:AUDITS]]
        while not all(self._recall(some[x], None if own is None else own[x], truth[x]) >= AUDIT_RECALL for x in sorts if len(x)):
            if self.width >= len(self.ids):
                self.scan = True  # parts of the graph cannot be reached
                return
            self.width = min(2 * self.width, len(self.ids))

    def _recall(self, queries: np.ndarray, own: np.ndarray | None, truth: np.ndarray) -> float:
        """Mean over the queries of the part of their links that the beam finds."""
        got = np.zeros(len(queries))
        for i in range(0, len(queries), 32):  # a query may have as many links as the shard has vectors
            part = queries[i : i + 32]
            q, p = _cosine_pairs(self.vectors, part, *self.graph.candidates(part, self.width))
            other = slice(None) if own is None else own[i + q] != self.ids[p]
            got[i : i + 32] = np.bincount(q[other], minlength=len(part))
        return float(np.minimum(got / truth, 1.0).mean())

    def links(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, point) found; of a scanned shard they may be very many, so the job asks for the matrix."""
        if self.scan:
            return np.nonzero(_linked_block(self.vectors, queries))
        return _cosine_pairs(self.vectors, queries, *self.graph.candidates(queries, self.width))


def _unit(column: pa.Array) -> np.ndarray:
    x = np.array(column.to_pylist(), np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard key, role, node, copies, vector), points of a shard first -> (node, root, links) per batch."""
    current, points, shard, held = None, [], None, []

    def out(node: np.ndarray, root: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root), pa.array(links)], names=["node", "root", "links"])

    def scanned(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        """All links of some queries, counted and united in the matrix of links, without a list of pairs."""
        near = _linked_block(shard.vectors, vectors) & (ids[:, None] != shard.ids)
        count = np.where(near, shard.copies, 0).sum(1)
        of_query, of_point = _least_reached(near, ids, shard.ids)
        asked, moved = count > 0, of_point < shard.ids
        return out(
            np.concatenate([ids[asked], shard.ids[moved]]),
            np.concatenate([of_query[asked], of_point[moved]]),
            np.concatenate([count[asked].astype(np.int64), np.zeros(moved.sum(), np.int64)]),
        )

    def respond(ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(ids), BATCH):
            part = slice(i, i + BATCH)
            found = scanned(ids[part], vectors[part]) if shard.scan else walked(ids[part], vectors[part])
            if found is not None:
                yield found

    def walked(ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch | None:
        q, p = shard.links(vectors)
        other = ids[q] != shard.ids[p]
        q, p = q[other], p[other]
        if not len(q):
            return None
        count = np.bincount(q, shard.copies[p], len(ids)).astype(np.int64)
        node, root = roots(ids[q], shard.ids[p])
        links = np.zeros(len(node), np.int64)
        asked = np.flatnonzero(count)
        links[np.searchsorted(node, ids[asked])] = count[asked]
        return out(node, root, links)

    def release() -> Iterator[pa.RecordBatch]:
        """Audit on the queries that were held back, and answer them."""
        nonlocal shard
        if held:
            ids, weights, xs = (np.concatenate(x) for x in zip(*points, strict=True))
            shard = Shard(ids, xs)
            shard.copies = weights
            shard.audit(np.concatenate([x for *_, x in held]), np.concatenate([x for x, *_ in held]))
            for asked in held:
                yield from respond(*asked)
            held.clear()

    for batch in batches:
        key = np.array([f"{a}\n{b}\n{c}" for a, b, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)], object)
        role, node, copies = (np.asarray(batch.column(i)) for i in (3, 4, 5))
        cuts = [i for i in range(1, len(key)) if key[i] != key[i - 1] or role[i] != role[i - 1]]
        for i, j in zip([0, *cuts], [*cuts, len(key)], strict=True):
            if i == j:
                continue
            if key[i] != current:
                yield from release()
                current, points, shard = key[i], [], None
            vectors = _unit(batch.column(6).slice(i, j - i))
            if role[i] == 0:
                points.append((node[i:j], copies[i:j], vectors))
            elif shard is not None:
                yield from respond(node[i:j], copies[i:j], vectors)
            elif points:
                held.append((node[i:j], copies[i:j], vectors))
                if sum(len(x) for x, *_ in held) >= GATHER:
                    yield from release()
    yield from release()


def links(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"):
    """Usable vectors folded by value, and their links: (folded, found).

    folded: label, vector, node (smallest id), copies. found: node, root (a star over linked vectors), links.
    """
    v = F.col(vector_col).cast("array<double>")
    usable = embeddings.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & v.isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("vector")
    ).where(
        "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)"
    )
    folded = stored(
        usable.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "vectors"
    ).withColumn("dim", F.size("vector"))
    sizes = folded.groupBy("label", "dim").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("shards"))
    dealt = folded.join(sizes, ["label", "dim"])
    home = F.pmod(F.xxhash64("node", "vector"), F.col("shards"))
    columns = [F.col("label").cast("string").alias("label"), "dim"]
    points = dealt.select(*columns, home.alias("shard"), F.lit(0).alias("role"), "node", "copies", "vector")
    # Every vector asks every shard of its label.
    queries = dealt.select(*columns, F.explode(F.expr("sequence(0L, shards - 1)")).alias("shard"), F.lit(1).alias("role"), "node", "copies", "vector")
    rows = points.unionAll(queries).repartition("label", "dim", "shard").sortWithinPartitions("label", "dim", "shard", "role", F.xxhash64("node"))
    found = stored(rows.mapInArrow(_answer, "node long, root long, links long"), "vector-links")
    return folded, found


def near_copies(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    folded, found = links(embeddings, id_col, vector_col, label_col)
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    # Written out, so that the engine can split a vector with very many copies when all rows are joined to it.
    per_node = stored(
        folded.select("label", "vector", F.xxhash64("vector").alias("h"), "node", "copies")
        .join(counts, "node", "left")
        .join(linked, "node", "left")
        .select(
            "label",
            "h",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        ),
        "vector-components",
    )
    every = embeddings.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).withColumn("h", F.when(F.col("vec_id").isNotNull(), F.xxhash64("vector")))
    return every.join(per_node, ["label", "h", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))

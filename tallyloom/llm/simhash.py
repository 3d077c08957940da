"""SimHash near-dedup: fingerprints of 3-word shingles, linked through a vantage-point tree.

Fingerprints: A-Z lower-cased, words between ASCII white space, 3-word shingles with repeats, XXH64 with
seed 42; a bit is set if more than half of the shingles have it.

Links at MAX_BITS or fewer differing bits are found on the distinct fingerprints. A vantage-point tree,
fitted on SAMPLE fingerprints, or on two a shard where more shards are needed, cuts Hamming space into shards: a node sends a fingerprint inside
when its distance to the vantage point is at most the node's radius. A fingerprint lies in one shard and
asks every shard that its ball of MAX_BITS can reach by the triangle inequality. Within a shard a second
tree of the same kind prunes the pairs, and each batch of queries returns the smallest partner group per
fingerprint instead of its pairs. Distances are exact, so no link is lost and none is added.

Random 64-bit fingerprints lie about 32 bits apart, so a ball of 3 crosses a median cut in six cases of ten:
queries are sent to about shards**0.68 shards. That is the price of the method at this radius.

Defined cases: null and empty texts have the fingerprint zero and link like any other. A row without doc_id
takes part; the smallest doc_id of its component is its component, null if there is none. Rows that repeat
a doc_id and differ in text are fingerprinted separately. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import components, fresh, roots

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
WORDS = 3
MAX_BITS = 3
SAMPLE = 4096
SHARD_ROWS = 32768
MIN_SHARDS = 16
LEAF = 256
CHUNK = 1 << 16
QUERY_BATCH = 4096


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of one text. Bits are counted in chunks, so a long text needs no more memory."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    shingles = max(1, len(words) - WORDS + 1)
    first, last = begins[:shingles], ends[len(words) - shingles :]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, shingles, CHUNK):
        spans = zip(first[i : i + CHUNK].tolist(), last[i : i + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > shingles).tobytes(), "big")


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fingerprint ``fp`` as a signed long, for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """A vantage-point tree over fingerprints; leaves hold positions in the given array."""

    def __init__(self, points: np.ndarray, leaf: int, depth: int = 64):
        self.points, self.leaf = points, leaf
        self.root = self._grow(np.arange(len(points)), depth)

    def _grow(self, at: np.ndarray, depth: int):
        if len(at) <= self.leaf or depth == 0:
            return at
        far = _distance(self.points[at], self.points[at[0]])
        radius = int(np.median(far))
        inside = far <= radius
        if inside.all():
            inside = far < radius
        if inside.all() or not inside.any():
            return at
        return self.points[at[0]], radius, self._grow(at[inside], depth - 1), self._grow(at[~inside], depth - 1), int(far[inside].max())

    def pairs(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, point) of all pairs at MAX_BITS or less."""
        found_q, found_p = [], []
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, at = todo.pop()
            if len(at) == 0:
                continue
            if isinstance(node, np.ndarray):
                for i in range(0, len(node), CHUNK // 64):
                    part = node[i : i + CHUNK // 64]
                    for j in range(0, len(at), 1024):
                        near = _distance(queries[at[j : j + 1024], None], self.points[part][None, :]) <= MAX_BITS
                        q, p = np.nonzero(near)
                        found_q.append(at[j + q])
                        found_p.append(part[p])
                continue
            vantage, _, inner, outer, reach = node
            far = _distance(queries[at], vantage).astype(np.int64)
            todo.append((inner, at[far <= reach + MAX_BITS]))
            # A point outside lies further than reach from the vantage point, its partner MAX_BITS nearer at most.
            todo.append((outer, at[far > reach - MAX_BITS]))
        if not found_q:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found_q), np.concatenate(found_p)


def _regions(sample: np.ndarray, shards: int) -> list[tuple[np.uint64, int, int, int]]:
    """Inner nodes (vantage, radius, inner child, outer child) of a tree with about ``shards`` leaves.

    Children below zero are shards: -1 - shard.
    """
    tree = Tree(sample, 0, max(0, (shards - 1).bit_length()))
    nodes: list = []
    leaves = 0

    def flatten(node) -> int:
        nonlocal leaves
        if isinstance(node, np.ndarray):
            leaves += 1
            return -leaves
        at = len(nodes)
        nodes.append(None)
        nodes[at] = (node[0], node[4], flatten(node[2]), flatten(node[3]))
        return at

    flatten(tree.root)
    return nodes


def _deal(nodes: list, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (shard, position, home) for every shard that a fingerprint lies in or can have partners in."""
    everyone = np.arange(len(prints))
    if not nodes:
        return np.zeros(len(prints), np.int64), everyone, np.ones(len(prints), bool)
    out, todo = [], [(0, everyone, np.ones(len(prints), bool))]
    while todo:
        node, at, home = todo.pop()
        if node < 0:
            out.append((np.full(len(at), -1 - node), at, home))
        elif len(at):
            vantage, radius, inner, outer = nodes[node]
            far = _distance(prints[at], vantage).astype(np.int64)
            into, beyond = far <= radius + MAX_BITS, far > radius - MAX_BITS
            todo.append((inner, at[into], home[into] & (far[into] <= radius)))
            todo.append((outer, at[beyond], home[beyond] & (far[beyond] > radius)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _shard_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, role, fp), points of a shard before its queries -> (a, b) links of each batch of queries.

    Only the points of the current shard are kept; its queries stream by.
    """
    current, parts, tree = None, [], None

    def answer(queries: np.ndarray) -> pa.RecordBatch | None:
        q, p = tree.pairs(queries)
        a, b = queries[q], tree.points[p]
        other = a != b
        if not other.any():
            return None
        node, root = roots(a[other], b[other])
        keep = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[keep].view(np.int64)), pa.array(root[keep].view(np.int64))], names=["a", "b"])

    for batch in batches:
        shard, role, prints = (np.asarray(batch.column(i)) for i in range(3))
        prints = prints.view(np.uint64)
        cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(role) != 0)) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)], strict=True):
            if i == j:
                continue
            if shard[i] != current:
                current, parts, tree = shard[i], [], None
            if role[i] == 0:
                parts.append(prints[i:j])
                continue
            if tree is None:
                if not parts:
                    continue
                tree = Tree(np.concatenate(parts), LEAF)
            for k in range(i, j, QUERY_BATCH):
                out = answer(prints[k : min(j, k + QUERY_BATCH)])
                if out is not None:
                    yield out


def links(prints: DataFrame) -> DataFrame:
    """From distinct fingerprints ``fp``: links ``a, b`` that connect all pairs at MAX_BITS or less.

    Groups of linked fingerprints within a batch come as a star instead of all their pairs.
    """
    rows = prints.count()
    shards = max(MIN_SHARDS, 1 << max(0, (rows // SHARD_ROWS)).bit_length())
    # Two or more a shard, so that the tree has as many leaves as shards are wanted: about one in 8,000 beyond SAMPLE.
    step = max(1, rows // max(SAMPLE, 2 * shards))
    sample = prints.where(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0).select("fp").toArrow()
    drawn = np.sort(np.asarray(sample.column(0)).view(np.uint64))
    nodes = _regions(np.random.default_rng(SEED).permutation(drawn), shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            shard, at, home = _deal(nodes, own)
            fp = own[at].view(np.int64)
            # Role 0: a point of the shard; role 1: a query to it. A point also asks its own shard.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([shard, shard[home]]).astype(np.int64)),
                    pa.array(np.concatenate([np.ones(len(shard)), np.zeros(home.sum())]).astype(np.int32)),
                    pa.array(np.concatenate([fp, fp[home]])),
                ],
                names=["shard", "role", "fp"],
            )

    dealt = prints.select("fp").mapInArrow(deal, "shard long, role int, fp long")
    return (
        dealt.repartition(shards, "shard")
        .sortWithinPartitions("shard", "role")
        .mapInArrow(_shard_links, "a long, b long")
    )


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    rows = stored(with_fingerprints(docs, id_col, text_col), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    found = components(links(prints))
    lowest = (
        found.join(prints, found.node == prints.fp)
        .groupBy("component")
        .agg(F.min("low").alias("component_id"))
    )
    named = found.join(lowest, "component").select(F.col("node").alias("fp"), "component_id")
    every = stored(prints.join(named, "fp", "left").select("fp", F.coalesce("component_id", "low").alias("component_id")), "named-fingerprints")
    # One row per fingerprint on the right, a plain table: a fingerprint of very many documents is split by the engine.
    return rows.join(every, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: the smallest doc_id of each component.

    Rows that share a doc_id stay or go together; a group whose rows all lack doc_id stays whole.
    """
    gone_id = fresh(docs, "near_gone")
    told = groups(docs, id_col, text_col).select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays"))
    # The few ids that go are written out: their size is known, and the engine sends them to the documents while it is small.
    gone = stored(
        told.groupBy(F.col("doc_id").alias(gone_id)).agg(F.bool_or("stays").alias("stays")).where("not stays").select(gone_id), "gone"
    )
    return docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[gone_id]), "left_anti")

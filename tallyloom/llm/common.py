"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Workers may not have this package on their path, so the code that runs there travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays. Null counts as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected components of the links a[i]-b[i] in memory: each node and the smallest node it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if np.array_equal(new, label):
            return nodes, nodes[label]
        label = new


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
    return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "low")
    moved = edges.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``a, b`` (long): ``node, component``, the smallest node reached.

    Alternates the large-star and small-star steps; each is written to the shared folder, so the lineage
    stays short and a lost executor costs one step. The smallest neighbours, one row per node, are written
    out as well: joined to a plain table, a node with very many links is split by the engine. Only nodes with a
    link to another node are returned; null ends and self links are passed over.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("xxhash64(b, a) % 1000003"))).first()
        if seen == mark:
            break
        mark = seen
        now = stored(_small_star(_large_star(now)), "links")
    star = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return star.unionAll(star.select(F.col("component").alias("node"), "component").distinct())

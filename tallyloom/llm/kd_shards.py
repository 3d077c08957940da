"""Sharding by a k-d tree: nodes are split at weighted medians along their widest metadata dimension.

Every document becomes a narrow row: its size and three metadata coordinates (log of the size, and the rank of
source and of lang among the distinct values in order), each scaled to 24 bits of its range over the whole table. Copies of a
text share the smallest coordinates among them, so they are neighbours in every order, and a cut divides at
most the copies of the text that it falls on. A node is split along the coordinate on
which its rows spread widest, at the point where the bytes left of it are half (or the due part) of the
node's. The point is found on 63-bit keys, coordinate first, then a hash of the text, then of the row's columns: a
histogram of the current interval names the part that holds the median, and the next one divides that
part, until a bound of it is near enough or it is one document. All rows are counted in every histogram, in parallel; a node
costs a bounded number of bins. Leaves left to right are the shards, numbered from 0.

Defined cases: a null text has size 1 and CRC 0; null metadata counts as empty and sorts first; rows that agree in doc_id,
text, source and lang are told apart by their place, so any number of copies can be divided. All other rows
get the same shard whatever the files they lie in. An empty table gives an empty result.
More than MAX_SHARDS shards raise ValueError, since the split points are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

MAX_SHARDS = 65536
ALL_BINS, NODE_BINS = 1 << 20, 1 << 14  # of one histogram, and of a node in it
EXACT_PART = 1 << 12  # a cut is near enough when it is off by at most 1/4096 of the node
COORDS = ("size", "source", "lang")
CODE_BITS, TIE_BITS = 24, 39
SLOT_ROWS = 100_000


def _ranked(rows: DataFrame, column: str) -> DataFrame:
    """Add ``raw_column``: the number of smaller distinct values. Values are ordered range by range, none in one task."""
    values = stored(rows.select(column).distinct(), "values")
    parts = max(1, values.count() // SLOT_ROWS)
    dealt = stored(values.repartitionByRange(parts, column).withColumn("part", F.spark_partition_id()), "value-ranges")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(column)) - 1
    ranks = dealt.withColumn("at", inside).join(starts, "part").select(column, (F.col("start") + F.col("at")).cast("long").alias(f"raw_{column}"))
    return rows.join(stored(ranks, "ranks"), column)


def _coordinates(docs: DataFrame) -> DataFrame:
    """Narrow rows: doc_id, size, crc, row, tie and the scaled coordinates x0, x1, ..."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in COORDS[1:]]
    rows = stored(
        docs.select(
            "doc_id",
            size.alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("crc"),
            F.xxhash64(text).alias("same"),
            F.monotonically_increasing_id().alias("place"),
            (F.log2(size.cast("double")) * (1 << 40)).cast("long").alias("raw_size"),
            *named,
        ).withColumn("row", F.xxhash64("doc_id", "same", *COORDS[1:])),
        "shard-rows",
    )
    repeated = stored(rows.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row", F.lit(True).alias("again")), "repeated")
    for c in COORDS[1:]:
        rows = _ranked(rows, c)
    rows = stored(
        rows.join(repeated, "row", "left").withColumn("row", F.when(F.col("again"), F.col("place")).otherwise(F.col("row"))),
        "ranked-rows",
    )
    lowest = [F.min(f"raw_{c}").alias(f"low_{c}") for c in COORDS[1:]]
    copies = stored(rows.groupBy("same", "crc").agg(F.count("*").alias("n"), *lowest).where("n > 1").drop("n"), "copies")
    # Six numbers; an empty table has none and any will do.
    ends = rows.agg(*[f(f"raw_{c}").alias(f"{n}_{c}") for c in COORDS for n, f in (("lo", F.min), ("hi", F.max))]).first()
    low = {c: ends[f"lo_{c}"] or 0 for c in COORDS}
    span = {c: (ends[f"hi_{c}"] or 0) - low[c] + 1 for c in COORDS}
    # Copies of a text share the upper part of the tie, so that they are neighbours in every order.
    tie = F.shiftleft(F.pmod(F.xxhash64("crc", "same"), F.lit(1 << 20)), 19) + F.pmod(F.xxhash64("row"), F.lit(1 << 19))
    raw = {c: F.coalesce(f"low_{c}", f"raw_{c}") if c in COORDS[1:] else F.col(f"raw_{c}") for c in COORDS}
    scaled = [
        F.floor((raw[c] - low[c]) / span[c] * ((1 << CODE_BITS) - 1)).cast("long").alias(f"x{i}") for i, c in enumerate(COORDS)
    ]
    placed = rows.join(copies, ["same", "crc"], "left").select("doc_id", "size", "crc", "row", tie.alias("tie"), *scaled)
    return stored(placed, "coordinates")


def _key(dim: Column) -> Column:
    code = F.element_at(F.array(*[F.col(f"x{i}") for i in range(len(COORDS))]), dim + 1)
    return F.shiftleft(code, TIE_BITS) + F.col("tie")


def _split_points(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """For each node of ``shards`` (node, stop: its shards are node..stop-1): node, stop, mid, dim, cut.

    Rows whose key along ``dim`` is below ``cut`` belong to the shards before ``mid``.
    """
    node = rows.groupBy("node").agg(
        F.sum("size").alias("weight"),
        *[f(f"x{i}").alias(f"{n}{i}") for i in range(len(COORDS)) for n, f in (("lo", F.min), ("hi", F.max))],
    )
    widths = F.array(*[F.struct((F.col(f"hi{i}") - F.col(f"lo{i}")).alias("w"), F.lit(-i).alias("d")) for i in range(len(COORDS))])
    pick = lambda side: F.element_at(F.array(*[F.col(f"{side}{i}") for i in range(len(COORDS))]), F.col("dim") + 1)
    state = (
        node.join(F.broadcast(shards), "node")
        .where("stop - node > 1")
        .withColumn("dim", -F.array_max(widths)["d"])
        .withColumn("mid", F.expr("node + (stop - node) div 2"))
        .select(
            "node",
            "stop",
            "mid",
            "dim",
            "weight",
            (F.col("weight") * (F.col("mid") - F.col("node")) / (F.col("stop") - F.col("node"))).alias("due"),
            F.lit(0).cast("double").alias("before"),
            F.shiftleft(pick("lo"), TIE_BITS).alias("lo"),
            (F.shiftleft(pick("hi") + 1, TIE_BITS) - 1).alias("hi"),
            F.lit(None).cast("long").alias("cut"),
        )
    )
    state = stored(state, "split")
    while open_nodes := state.where("cut is null").count():
        bins_each = min(NODE_BINS, max(16, ALL_BINS // open_nodes))
        step = F.expr(f"(hi - lo) div {bins_each} + 1")
        inside = (
            rows.join(F.broadcast(state.where("cut is null").select("node", "dim", "lo", "hi")), "node")
            .withColumn("key", _key(F.col("dim")))
            .where("key between lo and hi")
            .select("node", F.expr(f"(key - lo) div ((hi - lo) div {bins_each} + 1)").alias("bin"), "size")
        )
        bins = inside.groupBy("node", "bin").agg(F.sum("size").cast("double").alias("part"), F.count("*").alias("n"))
        run = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (
            bins.withColumn("upto", F.sum("part").over(run))
            .join(F.broadcast(state.where("cut is null").select("node", "before", "due")), "node")
            .where("before + upto >= due")
            .groupBy("node")
            .agg(F.min(F.struct("bin", "part", "upto", "n")).alias("hit"))
        )
        low = F.col("lo") + F.col("hit.bin") * step
        left = F.col("before") + F.col("hit.upto") - F.col("hit.part")
        right = F.col("before") + F.col("hit.upto")
        off = F.least(F.col("due") - left, right - F.col("due"))
        # Near enough, or a single document, which cannot be divided.
        done = (off * EXACT_PART <= F.col("weight")) | (F.col("hit.n") == 1) | (step == 1)
        nearest = F.when(F.col("due") - left <= right - F.col("due"), low).otherwise(low + step)
        open_ = F.col("cut").isNull()
        state = stored(
            state.join(F.broadcast(found), "node", "left").select(
                "node",
                "stop",
                "mid",
                "dim",
                "weight",
                "due",
                F.when(open_ & ~done, left).otherwise(F.col("before")).alias("before"),
                F.when(open_ & ~done, low).otherwise(F.col("lo")).alias("lo"),
                F.when(open_ & ~done, F.least(low + step - 1, F.col("hi"))).otherwise(F.col("hi")).alias("hi"),
                F.when(open_ & done, nearest).otherwise(F.col("cut")).alias("cut"),
            ),
            "split",
        )
    return state.select("node", "stop", "mid", "dim", "cut")


def shards_for(total: int, target_bytes: int) -> int:
    """How many leaves of at most about ``target_bytes`` the tree needs."""
    return max(1, -(-total // target_bytes))


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, source, lang): doc_id, size, crc, row, shard.

    Give the number of leaves or the bytes a leaf should reach.
    """
    rows = _coordinates(docs)
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = shards_for(total, target_bytes)
    if shards > MAX_SHARDS:
        raise ValueError(f"{shards} shards; at most {MAX_SHARDS}")
    spark = docs.sparkSession
    nodes = spark.range(1).select(F.lit(0).cast("long").alias("node"), F.lit(shards).cast("long").alias("stop"))
    rows = rows.withColumn("node", F.lit(0).cast("long"))
    width = shards
    while width > 1:
        cuts = _split_points(rows, nodes)
        to = F.broadcast(cuts.select("node", "mid", "dim", "cut"))
        rows = (
            rows.join(to, "node", "left")
            .withColumn("node", F.when(F.col("cut").isNull() | (_key(F.col("dim")) < F.col("cut")), F.col("node")).otherwise(F.col("mid")))
            .drop("mid", "dim", "cut")
        )
        nodes = nodes.join(F.broadcast(cuts.select("node", "mid")), "node", "left").select(
            F.explode(
                F.when(F.col("mid").isNull(), F.array(F.struct("node", "stop"))).otherwise(
                    F.array(F.struct("node", F.col("mid").alias("stop")), F.struct(F.col("mid").alias("node"), "stop"))
                )
            ).alias("s")
        ).select("s.node", "s.stop")
        nodes = stored(nodes, "nodes")
        width = -(-width // 2)
    return rows.select("doc_id", "size", "crc", "row", F.col("node").cast("int").alias("shard"))


def with_slots(assigned: DataFrame) -> DataFrame:
    """Add ``slot``: the place of a row in its shard, without gaps from 0.

    Rows of a shard are dealt into groups of about SLOT_ROWS by a hash; a group is numbered by itself and
    begins after the rows of the groups before it.
    """
    rows = stored(assigned, "assigned")
    parts = max(1, rows.count() // SLOT_ROWS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("row", "doc_id")
    return (
        rows.withColumn("at", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "part"])
        .withColumn("slot", (F.col("start") + F.col("at")).cast("long"))
        .drop("part", "at", "start")
    )

"""Exact dedup: a two-pass Bloom filter finds possibly repeated hashes; only those rows are shuffled.

Pass 1 maps every normalised text to one slot of a filter with 64 slots a row. Tasks count their slots, and
only those counts meet by a shuffle: 8 bytes a row, no id, digest or text. (Bitmaps of each task, merged by
or, would send 8 bytes a row and task.) Slots hit by more than one row are folded into a Bloom filter of
bitmaps, sized by their number and bounded by BROADCAST_BLOCKS. Pass 2 probes the broadcast filter in the
scan: a row that hits it may be a copy and goes on to the exact comparison by SHA-256; any other row is
certainly unique and passes straight through. The filter has no false negatives, so the result is exact; beyond its
bound it lets more unique rows through to the comparison, and whole documents still never meet it by a shuffle.

Defined cases: a null text counts as empty; empty texts are copies of each other. A row without doc_id
takes part, but the largest doc_id of a group stays, so such a row stays only in a group where no row has
one. Rows that repeat doc_id and text share one decision in ``copies``; ``drop_copies`` keeps one of them.
An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import fresh, lower_ascii

SLOTS_PER_ROW = 64  # a unique row shares its slot with another by chance in about 1 of 64 cases
BITS_PER_KEY = 16  # of the broadcast filter, two set for each slot that was hit again
BLOCK_SLOTS = 32768  # bits of one bitmap_construct_agg value, 4 KiB
BROADCAST_BLOCKS = 32768  # at most 128 MiB of filter


class Size(NamedTuple):
    """Slots of the first pass, and blocks of the filter that the second one probes."""

    slots: int
    blocks: int


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(text), 256))


def _slot(digest: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(slots))


def _places(slot: Column, blocks: int) -> list[Column]:
    """The block of a slot in the filter and its two bits there."""
    low, high = F.xxhash64(slot, F.lit(0)), F.xxhash64(slot, F.lit(1))
    bit = F.lit(BLOCK_SLOTS)
    return [
        F.pmod(low, F.lit(blocks)).alias("block"),
        F.pmod(high, bit).alias("bit1"),
        F.pmod(F.shiftright(high, 20), bit).alias("bit2"),
    ]


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1


def _folded(slots: DataFrame, of: int) -> tuple[DataFrame, Size]:
    """Distinct ``slot`` values, of ``of`` possible ones, as ``block, bitmap`` and the filter's size."""
    keys = stored(slots, "slots")
    blocks = max(1, min(BROADCAST_BLOCKS, -(-keys.count() * BITS_PER_KEY // BLOCK_SLOTS)))
    hits = keys.select(*_places(F.col("slot"), blocks)).select("block", F.explode(F.array("bit1", "bit2")).alias("bit"))
    return stored(hits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")), "bloom"), Size(of, blocks)


def repeat_filter(digests: DataFrame) -> tuple[DataFrame, Size]:
    """Pass 1. From ``digest``: the filter ``block, bitmap`` of slots that several rows hit, and its size.

    Hits are counted before the shuffle, so a text with very many copies sends one count from each task."""
    of = max(1, digests.count() * SLOTS_PER_ROW)
    hits = digests.select(_slot(F.col("digest"), of).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    return _folded(hits.where("n > 1").select("slot"), of)


def flag_repeats(rows: DataFrame, digest: str, bitmaps: DataFrame, size: Size, name: str) -> DataFrame:
    """Pass 2. Add the boolean ``name``: False only where no other row has the same digest."""
    block, bit1, bit2, bitmap = (fresh(rows, f"bloom_{x}") for x in ("block", "bit1", "bit2", "bitmap"))
    places = _places(_slot(F.col(digest), size.slots), size.blocks)
    at = [c.alias(n) for c, n in zip(places, (block, bit1, bit2), strict=True)]
    side = F.broadcast(bitmaps.select(F.col("block").alias(f"{block}r"), F.col("bitmap").alias(bitmap)))
    probed = rows.select("*", *at).join(side, F.col(block) == F.col(f"{block}r"), "left")
    hit = F.coalesce(_is_set(F.col(bitmap), F.col(bit1)) & _is_set(F.col(bitmap), F.col(bit2)), F.lit(False))
    return probed.withColumn(name, hit).drop(block, bit1, bit2, bitmap, f"{block}r")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Narrow rows (id and digest) are written once; the texts are read a single time.
    """
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest")), "digests")
    flagged = flag_repeats(rows, "digest", *repeat_filter(rows), "maybe")
    single = flagged.where("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest"
    )
    maybe = flagged.where("maybe").select("doc_id", "digest")
    # One row per text, written out: joined to a plain table, the engine can split a text with very many copies.
    groups = stored(maybe.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
    several = maybe.join(groups, "digest").select("doc_id", "keep_id", "group_size", "digest")
    return single.unionAll(several).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without copies, with all their columns.

    Ids and digests alone tell which rows go. A second filter holds just the texts that do repeat, so a whole document
    is shuffled only if it has a copy, or hits that filter by chance, and then by text and id: a text with very many
    copies is spread over the tasks.
    """
    digest, key, maybe = (fresh(docs, f"copy_{x}") for x in ("digest", "key", "maybe"))
    by = [digest, key]
    of_row = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))  # rows without an id have one key
    rows = docs.select("*", text_digest(F.col(text_col)).alias(digest), of_row.alias(key))
    narrow = stored(rows.select(F.col(id_col).alias("doc_id"), F.col(digest).alias("digest"), F.col(key).alias("key")), "digests")
    bitmaps, size = repeat_filter(narrow)
    again = flag_repeats(narrow, "digest", bitmaps, size, "maybe").where("maybe").drop("maybe")
    groups = stored(again.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1"), "groups")
    gone = again.join(groups, "digest").where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    gone = stored(gone.select(F.col("digest").alias(digest), F.col("key").alias(key)), "gone")
    repeated = groups.select(_slot(F.col("digest"), size.slots).alias("slot")).distinct()
    flagged = flag_repeats(rows, digest, *_folded(repeated, size.slots), maybe)
    chosen = flagged.where(F.col(maybe)).dropDuplicates(by).join(gone, by, "left_anti")
    return flagged.where(~F.col(maybe)).select(*docs.columns).unionAll(chosen.select(*docs.columns))

"""Harmonic packing of token sequences.

A length l belongs to the class k = capacity // l, the reciprocal 1/k of the capacity that it fits, and a
bin of class k holds exactly k pieces. A document is first cut into whole sequences; of the rest, the
largest class size (capacity // k) is cut off again until what remains fills its class well, wasting at
most MAX_WASTE tokens of a bin. So most documents end in one to three pieces and bins have little padding.

Each task fills the bins of its own documents, batch by batch, without a shuffle. What is left of each
class in a batch, fewer than k pieces, goes through the same rule once more over the whole table: pieces of
a class are numbered by prefix sums over batches, and k successive ones form a bin. Only the last, unfilled
bin of each class remains; those at most capacity * H(capacity) pieces, a fixed number at any input size,
are put together first-fit in one task.

Defined cases: null text counts as empty and has just the end id; null doc_id is carried along; repeated
rows are packed as documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import sys
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 1024
MAX_WASTE = 32
END_ID = 0
LOCAL_BINS = 1 << 24  # sequence numbers of one batch
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, sequence_id long, offset long, batch long, place long"
# Pre-tokenisation pattern of the byte-level vocabulary (fixed value of the public tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_bpe_encoder(json_path: str, ranks_path: str) -> Callable[[str], list[int]]:
    """Ids of the tokenizer in ``json_path`` as it stands, so a special string in a text is its one id.

    The same vocabulary as ranks gives the same ids several times faster; a text on which that library
    gives up (extremely long runs of white space) goes to the tokenizer itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    with open(json_path, encoding="utf-8") as lines:
        special = {token["content"]: token["id"] for token in json.load(lines)["added_tokens"]}
    fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    slow: list = []

    def encode(text: str) -> list[int]:
        try:
            if any(string in text for string in special):
                return fast.encode(text, allowed_special="all")
            return fast.encode_ordinary(text)
        except BaseException as stop:  # the library reports its own failure as a panic
            if isinstance(stop, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if not slow:
                slow.append(Tokenizer.from_file(json_path))
            return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def waste(length: int, capacity: int = CAPACITY) -> int:
    """Padding of a bin filled with pieces of this length."""
    return capacity - capacity // length * length


def cut(tokens: int, capacity: int = CAPACITY, max_waste: int = MAX_WASTE) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (tokens // capacity)
    rest = tokens % capacity
    while rest and waste(rest, capacity) > max_waste:
        # The largest capacity // k below rest, found from the class of rest.
        size = capacity // (capacity // rest + 1)
        out.append(size)
        rest -= size
    return out + [rest] * (rest > 0)


def _pack_batch(rows: list[tuple], base: int, capacity: int) -> dict[str, list]:
    """Fill the bins of one batch of pieces (doc, start, length, crc, tokens); left-over pieces have no sequence."""
    out: dict[str, list] = defaultdict(list)
    by_class: dict[int, list[int]] = defaultdict(list)
    for i, row in enumerate(rows):
        by_class[capacity // row[2]].append(i)
    bins = 0
    for k, members in sorted(by_class.items()):
        members.sort(key=lambda i: -rows[i][2])  # like lengths together
        whole = len(members) // k * k
        at = 0
        for n, i in enumerate(members):
            full = n < whole
            at = 0 if n % k == 0 else at
            for name, value in zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens"), rows[i], strict=True):
                out[name].append(value)
            out["class"].append(k)
            out["sequence_id"].append(base + bins if full else None)
            out["offset"].append(at if full else None)
            out["place"].append(None if full else n - whole)
            at += rows[i][2]
            if full and n % k == k - 1:
                bins += 1
    out["batch"] = [base] * len(out["class"])
    return out


def _first_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, longest first."""
    order, room, placed = sorted(range(len(lengths)), key=lambda i: -lengths[i]), [], [(0, 0)] * len(lengths)
    for i in order:
        b = next((b for b, free in enumerate(room) if free >= lengths[i]), len(room))
        if b == len(room):
            room.append(capacity)
        placed[i] = (b, capacity - room[b])
        room[b] -= lengths[i]
    return placed


def pack(
    docs: DataFrame,
    encoder: Callable[[], Callable[[str], list[int]]],
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``encoder`` makes the function text -> ids in each task. Texts are tokenized once and the pieces written
    to the shared folder; all later steps work on those narrow rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder(), 0
        schema = pa.schema([(f.split()[0], {"long": pa.int64(), "int": pa.int32()}[f.split()[1]]) for f in PIECE.split(", ")])
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4")
                doc, start = doc.as_py(), 0
                for length in cut(len(ids), capacity):
                    rows.append((doc, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids)))
                    start += length
            base = (TaskContext.get().partitionId() << 38) + number * LOCAL_BINS
            number += 1
            packed = _pack_batch(rows, base, capacity)
            yield pa.RecordBatch.from_arrays([pa.array(packed[f.name], f.type) for f in schema], schema=schema)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(texts.mapInArrow(run, PIECE), "pieces")

    left = pieces.where("sequence_id is null").drop("sequence_id", "offset")
    counts = left.groupBy("class", "batch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("class").orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "class",
        "batch",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
        F.sum("n").over(Window.partitionBy("class")).alias("total"),
    )
    numbered = left.join(starts, ["class", "batch"]).select(
        *[c for c in left.columns if c not in ("place", "batch")],
        F.expr("(first + place) div class").alias("bin"),
        F.expr("(first + place) % class").alias("member"),
        F.expr("(first + place) div class < total div class").alias("full"),
    )
    # Bins over the whole table; the numbers lie above all those of batches.
    inside = Window.partitionBy("class", "bin").orderBy("member").rowsBetween(Window.unboundedPreceding, -1)
    shared = numbered.where("full").select(
        "*",
        (F.lit(1 << 61) + F.col("class") * F.lit(1 << 48) + F.col("bin")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset"),
    )

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if table.num_rows:
            placed = _first_fit(table.column("length").to_pylist(), capacity)
            table = table.append_column("sequence_id", pa.array([(1 << 62) + b for b, _ in placed], pa.int64()))
            table = table.append_column("offset", pa.array([o for _, o in placed], pa.int64()))
            yield from table.combine_chunks().to_batches()

    wanted = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kind = ", ".join(f"{c} long" for c in wanted)
    # Fewer than k pieces of each class k are open here, whatever the size of the table.
    rest = numbered.where("not full").select(*wanted).repartition(1).mapInArrow(last, f"{kind}, sequence_id long, offset long")
    columns = [*wanted, "sequence_id", "offset"]
    return pieces.where("sequence_id is not null").select(*columns).unionAll(shared.select(*columns)).unionAll(rest)

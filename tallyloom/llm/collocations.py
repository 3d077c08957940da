"""Phrase collocations: phrases of 2 to 4 words, counted losslessly in counting quotient filters.

Texts are cut into pieces and words, held as blocks of word numbers of one language. Words with ``least`` occurrences get
ids; a phrase that frequent has frequent parts only, so phrases grow by one word at a time. At each length every
block counts its phrases in a quotient filter of packed ids (``quotient``), cut into chunks of the key space. The
filters of a chunk are merged where the chunk is, which gives the phrases' counts in the whole corpus, and each
block hears by one bit a key which of its phrases are frequent. Only stretches of those go on to the next length. So one
key, however frequent, is one entry of a block's filter; chunks are even since keys are permuted, and their number grows with
the corpus; dictionaries go to blocks, never to all tasks.

The score of a candidate is the lowest over its cuts of floor(scale * a / (l + r)), in exact decimals. A candidate inside a longer one
that holds ``inside`` percent of its occurrences is dropped.

Defined cases: a null text has no words; a null lang is "und"; repeated rows count each time; an empty table, or one
without frequent words, gives an empty result. Equal scores and counts rank by the bytes of the phrase.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .quotient import Packing

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, LONGEST, TOP = 30, 4, 2000
SCALE, INSIDE = 2_000_000, 80
NO_LANG = "und"
BLOCK_BYTES = 6 << 20  # text of one block; a longer text is a block by itself
CHUNK_KEYS = 1 << 18  # keys, over all blocks, that a chunk of the key space is meant for
RANKED = 200_000  # candidates of a language that one task puts in order first
#: Bytes that end a piece become full stops, tabs become blanks.
PIECES = bytes.maketrans(b",;:!?\x0a\x0b\x0c\x0d\x09", b"........." + b" ")


class _Numbers(dict):
    """Numbers words in the order in which they first come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_blocks(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, lang, tokens, words, counts``: texts of one language as numbers into the block's own word list.

    ``tokens`` are 32-bit numbers; -1 ends a piece.
    """
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("tokens", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, list] = {}  # per language: word numbers, tokens, bytes of text

        def handed(lang: str) -> pa.RecordBatch:
            nonlocal made
            numbers, parts, _ = held.pop(lang)
            tokens = np.concatenate(parts)
            counts = np.bincount(tokens[tokens >= 0], minlength=len(numbers) - 1)
            words = [w.decode("utf-8") for w in list(numbers)[1:]]
            columns = [[task << 32 | made], [lang], [tokens.astype("<i4").tobytes()], [words], [counts.tolist()]]
            made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid or not (raw := text.as_buffer().to_pybytes()):
                    continue
                # Of bytes only A-Z are lower-cased; a full stop stands for the end of a piece and is number 0.
                found = raw.lower().translate(PIECES).replace(b".", b" . ").split()
                mine = held.setdefault(lang, [_Numbers({b".": 0}), [], 0])
                mine[1].append(np.fromiter(map(mine[0].__getitem__, found), np.int32, len(found)) - np.int32(1))
                mine[1].append(np.array([-1], np.int32))
                mine[2] += len(raw)
                if mine[2] >= block_bytes:
                    yield handed(lang)
            while sum(m[2] for m in held.values()) >= 2 * block_bytes:
                yield handed(max(held, key=lambda k: held[k][2]))
        for lang in list(held):
            yield handed(lang)

    narrow = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "block long, lang string, tokens binary, words array<string>, counts array<long>")


def frequent_words(blocks: DataFrame, least: int) -> DataFrame:
    """``lang, word, f, id``: gapless ids over all languages, numbered where the words lie."""
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    counts = each.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")).where(F.col("f") >= least)
    placed = stored(counts.withColumn("place", F.monotonically_increasing_id()), "word-places")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row per partition of the table above.
    first = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("part", part).join(F.broadcast(first), "part").select("lang", "word", "f", (F.col("first") + within).alias("id"))
    return stored(numbered, "word-ids")


def stretches(ids: np.ndarray, hit: np.ndarray, n: int) -> np.ndarray:
    """The tokens of neighbouring hits, two at least, where a hit is the start of a frequent n-gram; -1 between."""
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    several = after - first > 1
    first, size = first[several], (after - first)[several] + n - 1
    if not len(first):
        return np.empty(0, np.int64)
    ends = np.cumsum(size + 1)
    out = np.repeat(first - (ends - size - 1), size + 1) + np.arange(ends[-1])
    kept = ids[np.minimum(out, len(ids) - 1)]
    kept[ends - 1] = -1
    return kept


def grams(ids: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where n-grams start, and their ids place by place."""
    if len(ids) < n:
        return np.empty(0, np.int64), [np.empty(0, np.int64)] * n
    whole = np.ones(len(ids) - n + 1, bool)
    for k in range(n):
        whole &= ids[k : len(ids) - n + 1 + k] >= 0
    at = np.flatnonzero(whole)
    return at, [ids[at + k] for k in range(n)]


STREAM = "block long, lang string, ids binary"
NO_ID = (1 << 32) - 1  # between stretches; ids are smaller


def packed(ids: np.ndarray) -> bytes:
    """Ids of a stream, 32 bits each; -1 between stretches."""
    return np.where(ids < 0, NO_ID, ids).astype("<u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    ids = np.frombuffer(data, "<u4").astype(np.int64)
    ids[ids == NO_ID] = -1
    return ids


def id_streams(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """``block, lang, ids``: stretches of two frequent words or more."""
    mine = blocks.select("block", "lang", F.posexplode("words").alias("at", "word")).join(words, ["lang", "word"])
    known = mine.groupBy("block").agg(F.collect_list("at").alias("at"), F.collect_list("id").alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens = np.frombuffer(batch.column(2)[i].as_py(), "<i4")
                at, id_ = (batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in (3, 4))
                table = np.full(int(tokens.max(initial=0)) + 2, -1, np.int64)
                table[at] = id_
                ids = table[tokens]  # the last entry answers for -1
                kept = stretches(ids, ids >= 0, 1)
                if len(kept):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([packed(kept)])], names=["block", "lang", "ids"])

    return blocks.select("block", "lang", "tokens").join(known, "block").mapInArrow(run, STREAM)


def block_filters(streams: DataFrame, packing: Packing) -> DataFrame:
    """``chunk, block, filter``: the quotient filter of each block's n-grams, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, places = grams(unpacked(batch.column(2)[i].as_py()), packing.n)
                if not len(places[0]):
                    continue
                a, b, counts, _ = packing.distinct(*packing.permuted(places))
                chunks, first = np.unique(packing.chunk_of(a), return_index=True)
                edges = [*first.tolist(), len(a)]
                made = [packing.encoded(a[x:y], b[x:y], counts[x:y]) for x, y in zip(edges, edges[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(chunks), pa.array(np.full(len(chunks), batch.column(0)[i].as_py())), pa.array(made, pa.binary())], names=["chunk", "block", "filter"])

    return streams.mapInArrow(run, "chunk long, block long, filter binary")


def merged(filters: DataFrame, packing: Packing, least: int) -> DataFrame:
    """Merge the filters of each chunk. Rows with ``ids, f`` are frequent n-grams; rows with ``block, chunk, bits`` tell
    a block which keys of its filter are."""
    answer = pa.schema([("ids", pa.list_(pa.int64())), ("f", pa.int64()), ("block", pa.int64()), ("chunk", pa.int64()), ("bits", pa.binary())])

    def merge(chunk_rows: pa.Table) -> pa.Table:
        chunk = chunk_rows.column("chunk")[0].as_py()
        parts = [packing.decoded(chunk, x) for x in chunk_rows.column("filter").to_pylist()]
        a, b, counts, at = packing.distinct(*(np.concatenate([p[k] for p in parts]) for k in range(3)))
        often = counts >= least
        ids = np.stack(packing.restored(a[often], b[often]), axis=1)
        hits = np.split(often[at], np.cumsum([len(p[0]) for p in parts])[:-1])
        heard = [(block, np.packbits(h, bitorder="little").tobytes()) for block, h in zip(chunk_rows.column("block").to_pylist(), hits, strict=True) if h.any()]
        n, m = len(ids), len(heard)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * packing.n), pa.array(ids.ravel()))
        return pa.table(
            [
                pa.concat_arrays([flat, pa.nulls(m, answer.field("ids").type)]),
                pa.concat_arrays([pa.array(counts[often], pa.int64()), pa.nulls(m, pa.int64())]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([x for x, _ in heard], pa.int64())]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([chunk] * m, pa.int64())]),
                pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([x for _, x in heard], pa.binary())]),
            ],
            schema=answer,
        )

    return filters.groupBy("chunk").applyInArrow(merge, "ids array<long>, f long, block long, chunk long, bits binary")


def grown(streams: DataFrame, answers: DataFrame, packing: Packing) -> DataFrame:
    """The streams cut down to stretches of frequent n-grams, in which longer ones may lie."""
    heard = answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("chunk", "bits")).alias("heard"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = unpacked(batch.column(2)[i].as_py())
                at, places = grams(ids, packing.n)
                a, _, _, row = packing.distinct(*packing.permuted(places))
                chunks = packing.chunk_of(a)
                often = np.zeros(len(a), bool)
                for part in batch.column(3)[i].as_py():
                    x, y = np.searchsorted(chunks, [part["chunk"], part["chunk"] + 1])
                    often[x:y] = np.unpackbits(np.frombuffer(part["bits"], np.uint8), count=y - x, bitorder="little")
                hit = np.zeros(len(ids), bool)
                hit[at] = often[row]
                kept = stretches(ids, hit, packing.n)
                if len(kept):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([packed(kept)])], names=["block", "lang", "ids"])

    return streams.join(heard, "block").select("block", "lang", "ids", "heard").mapInArrow(run, STREAM)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES, chunk_keys: int = CHUNK_KEYS):
    """Frequent phrases ``ids, f`` of 1 to ``longest`` words, the words behind the ids, and ``lang, n``."""
    blocks = stored(word_blocks(docs, lang_col, text_col, block_bytes), "word-blocks")
    totals = stored(blocks.groupBy("lang").agg(F.sum(F.expr("aggregate(counts, 0L, (s, x) -> s + x)")).alias("n")), "lang-totals")
    words = frequent_words(blocks, least)
    size, all_words = words.agg(F.count("*")).first()[0], totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits, chunk_bits = max(1, int(size).bit_length()), max(0, (int(all_words) // chunk_keys).bit_length())
    found = words.select(F.array("id").alias("ids"), "f")
    streams = stored(id_streams(blocks, words), "id-streams")
    for n in range(2, longest + 1):
        packing = Packing(n, bits, chunk_bits)
        answers = stored(merged(block_filters(streams, packing), packing, least), f"phrases-{n}")
        found = found.unionAll(answers.where("ids is not null").select("ids", "f"))
        if n < longest:
            streams = stored(grown(streams, answers, packing), "id-streams")
    return found, words, totals


def scored(found: DataFrame, scale: int = SCALE) -> DataFrame:
    """``ids, a, l, r, score`` of phrases of two words or more: the cut with the lowest score, then the shortest first part."""
    cuts = found.where("size(ids) > 1").select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    sides = cuts.select("ids", "a", "k", F.explode(F.expr("array(struct(0 as side, slice(ids, 1, k) as part), struct(1 as side, slice(ids, k + 1, size(ids)) as part))")).alias("s"))
    part = sides.select("ids", "a", "k", "s.side", "s.part").join(found.select(F.col("ids").alias("part"), "f"), "part")
    both = part.groupBy("ids", "k").agg(F.first("a").alias("a"), F.sum(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.sum(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    # 19 digits times 7 fit a decimal, which 64 bits may not.
    value = F.expr(f"cast({scale} as decimal(7,0)) * cast(a as decimal(19,0)) div cast(l + r as decimal(19,0))")
    best = both.withColumn("score", value).groupBy("ids").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b"))
    return best.select("ids", "b.a", "b.l", "b.r", "b.score")


def held_inside(found: DataFrame, inside: int = INSIDE) -> DataFrame:
    """``ids`` of phrases that lie in a longer one with ``inside`` percent of their occurrences."""
    longer = found.where("size(ids) > 2").select("ids", "f", F.explode(F.expr("sequence(2, size(ids) - 1)")).alias("n"))
    parts = longer.select(F.explode(F.expr("transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n))")).alias("ids"), "f")
    most = parts.groupBy("ids").agg(F.max("f").alias("most"))
    wide = "cast({} as decimal(19,0)) * {}"
    return most.join(found, "ids").where(f"{wide.format('most', 100)} >= {wide.format('f', inside)}").select("ids")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, block_bytes: int = BLOCK_BYTES, chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found, words, totals = phrase_counts(docs, lang_col, text_col, least, longest, block_bytes, chunk_keys)
    found = stored(found, "phrases")
    open_ = stored(scored(found).join(held_inside(found), "ids", "left_anti"), "candidates")
    each = open_.select("ids", F.posexplode("ids").alias("at", "id")).join(words, "id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
    named = stored(open_.join(each.groupBy("ids").agg(F.min("lang").alias("lang"), text.alias("phrase")), "ids").drop("ids"), "named")
    # The first of every part, then the first of those; so no task orders all candidates of a language.
    parts = max(1, -(-named.count() // RANKED))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
    front = named.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = front.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

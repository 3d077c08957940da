"""Spelling variants: words one edit apart, found by pivotal grams, and the form each variant stands for.

Words are counted in every text, then signed once. Bigrams are ranked by how many places of words hold them, rare
ones first. A word's gram prefix is its three rarest bigrams (q * distance + 1, with every further place of the last
one); its pivots are two bigrams of the prefix that share no character, chosen by dynamic programming so that
together they occur least often. One edit spoils at most one of two disjoint bigrams, so the other one stays in the near
word, and its place from the side without the edit stays too. It lies in the near word's prefix if that prefix reaches at
least as far in the ranking. So every word looks its pivots up among the prefixes that reach as far as its own, at the
places that one edit allows, and what is found is verified by the edit distance.

Defined cases: a null text has no words; a null doc_id is written as the empty string; repeated rows count each
time. An empty table, or one without words, gives an empty result. A text of any length is read whole. Of near
words with equal counts the first in code-point order is the form.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_CHARS, MIN_COUNT = 6, 5
SLIP = 199  # every so many-th word of a document loses a character
FORM_TIMES = 5  # a form is that many times as frequent as its variant
PREFIX = 3  # bigram length 2 times distance 1, plus 1
HELD_WORDS = 300_000  # different words that a task holds before it hands their counts on
ASKED = 2000  # lookups of the same gram, place and length that one task answers
LETTERS = "a-zA-ZÀ-ÿ"


def slipped(word: str, seed: int, slip: int) -> str:
    """The word as the document spells it; ``seed`` is the CRC-32 of the document's id and a colon."""
    h = zlib.crc32(word.encode("utf-8"), seed)
    if h % slip:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """``word, n``: the words of all texts, counted in each task before they are shuffled."""
    run_of = re.compile(f"[{LETTERS}]{{{min_chars},}}")  # a run that long is matched whole

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Of bytes only A-Z are lower-cased.
                for word, n in Counter(run_of.findall(text.as_buffer().to_pybytes().lower().decode("utf-8"))).items():
                    kept = slipped(word, seed, slip)
                    if len(kept) >= min_chars:
                        held[kept] += n
                if len(held) >= HELD_WORDS:
                    yield handed()
        if held:
            yield handed()

    narrow = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = narrow.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """How many places of words each bigram has. There are at most 90 letters, so at most 8,100 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                held.update(map("".join, zip(word, word[1:])))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["gram", "n"])

    found = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in found.collect()}


def gram_prefix(word: str, rank: dict[str, int]) -> list[tuple[int, int]]:
    """Rank and position of the rarest bigrams, in order of rank: three, and all further places of the last."""
    grams = sorted((rank[word[i : i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(PREFIX, len(grams)) - 1][0]
    return [g for g in grams if g[0] <= last]


def pivots(prefix: list[tuple[int, int]], count: list[int]) -> list[tuple[int, int]]:
    """Two bigrams of the prefix without a common character that together occur least often.

    Dynamic programming along the positions: the cheapest bigram that ends before the current one starts, and the
    cheapest pair so far. Three different positions always hold such a pair.
    """
    by_place = sorted(prefix, key=lambda g: g[1])
    single: list[tuple[int, tuple[int, int]]] = []  # up to place i, the cheapest bigram
    pair: tuple[int, tuple[int, int], tuple[int, int]] | None = None
    free = -1  # the last bigram that ends before the current one starts
    for i, gram in enumerate(by_place):
        cost = count[gram[0]]
        while by_place[free + 1][1] + 2 <= gram[1]:
            free += 1
        if free >= 0 and (pair is None or single[free][0] + cost < pair[0]):
            pair = (single[free][0] + cost, single[free][1], gram)
        single.append(min(single[-1], (cost, gram)) if i else (cost, gram))
    assert pair is not None
    return list(pair[1:])


def signed(words: DataFrame) -> DataFrame:
    """``word, n, size, reach, pivots, prefix``: the grams of each word, and the rank of its last prefix gram."""
    counts = bigram_counts(words)
    order = sorted(counts, key=lambda g: (counts[g], g))
    rank, count = {g: i for i, g in enumerate(order)}, [counts[g] for g in order]
    grams = pa.list_(pa.struct([("gram", pa.int32()), ("at", pa.int32())]))

    def listed(pairs: list[tuple[int, int]]) -> list[dict[str, int]]:
        return [{"gram": g, "at": i} for g, i in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            prefixes = [gram_prefix(w, rank) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(list(map(len, words)), pa.int32()),
                    pa.array([p[-1][0] for p in prefixes], pa.int32()),
                    pa.array([listed(pivots(p, count)) for p in prefixes], grams),
                    pa.array(list(map(listed, prefixes)), grams),
                ],
                names=["word", "n", "size", "reach", "pivots", "prefix"],
            )

    kind = "array<struct<gram: int, at: int>>"
    return words.select("word", "n").mapInArrow(run, f"word string, n long, size int, reach int, pivots {kind}, prefix {kind}")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``: all pairs of words one edit apart, in both directions.

    The edit lies before the second pivot or not. If it does, the near word has that pivot as far from its end,
    and the same characters behind it. If not, the first pivot stands where it stood, behind the same
    characters. So a lookup goes by a pivot, its place from that side and the characters on that side. Where very many
    words ask for the same, they are dealt out to several tasks.
    """
    known = stored(signed(words), "signed-words")
    left, right = "concat('<', substring(word, 1, {0} + 2))", "concat('>', substring(word, {0} + 1))"
    first, second = F.col("pivots")[0]["at"], F.col("pivots")[1]["at"]
    asked = known.select(
        "word", "n", "reach",
        F.explode(F.array(F.struct(F.expr(left.format("pivots[0].at")).alias("side"), second.alias("same")), F.struct(F.expr(right.format("pivots[1].at")).alias("side"), F.lit(0).alias("same")))).alias("a"),
        F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("long"),
    ).select("word", "n", "reach", "a.side", "a.same", "long")
    index = known.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("reach").alias("near_reach"), F.col("size").alias("long"), "word", F.explode("prefix").alias("g"))
    index = index.select("near", "near_n", "near_reach", "long", F.explode(F.array(F.expr(left.format("g.at")), F.expr(right.format("g.at")))).alias("side"))
    parts = F.ceil(F.count("*") / ASKED).cast("int").alias("parts")
    hot = stored(asked.groupBy("side", "long").agg(parts).where("parts > 1"), "hot-grams")
    asked = asked.join(hot, ["side", "long"], "left").withColumn("part", F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int"))
    index = index.join(hot, ["side", "long"], "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    found = (
        asked.join(index, ["side", "long", "part"])
        .where("reach <= near_reach and word <> near and substring(word, 1, same) = substring(near, 1, same)")
        .where(F.levenshtein("word", "near", 1) == 1)
    )
    one = F.struct("word", "n").alias("x"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n")).alias("y")
    pairs = found.select(*one).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
    both = F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return pairs.select(both.alias("p")).select(
        F.col("p.x.word").alias("word"), F.col("p.x.n").alias("n"), F.col("p.y.word").alias("near"), F.col("p.y.n").alias("near_n")
    )


def last_forms(forms: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """``word, root``: from each word with a form, follow the forms to the last.

    Counts rise by ``times`` at each step, so chains are short: their longest possible length, known from the
    largest count, says how often all links are doubled.
    """
    top = forms.agg(F.max("form_n")).first()[0] or 0
    steps, reach = 0, 1  # links followed so far
    while times**reach <= top:
        steps, reach = steps + 1, reach * 2
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(steps):
        now = stored(now, "forms")
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return now


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, times: int = FORM_TIMES, slip: int = SLIP
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    if min_chars <= PREFIX or times < 2:
        raise ValueError(f"words need more than {PREFIX} characters, and a form at least twice the count")
    words = stored(word_counts(docs, id_col, text_col, min_chars, min_count, slip), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_pairs(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.less") >= F.lit(times) * F.col("n")
    near = stored(
        near.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "near-words"
    )
    roots = last_forms(near.where("form is not null").select("word", "form", "form_n"), times)
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )

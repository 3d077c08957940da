"""Quality: positive-unlabelled learning with the non-negative risk estimator.

Only documents labelled as good are trusted; all other documents are unlabelled web text, good and bad. A text
becomes a vector of measures (``text_features``), one byte each, computed once and stored. A first model tells
trusted from unlabelled texts; over all documents its scores give the class prior: the smallest ratio of the share of
unlabelled to the share of trusted texts above a score, each with its sampling error (best bin estimation). With
that prior p the second model minimises

    p * E_trusted[loss(f)] + max(0, E_unlabelled[loss(-f)] - p * E_trusted[loss(-f)])

with the logistic loss; where the second term turns negative, a step makes it rise again instead. The score is
the logistic function of f, so one half divides the classes.

Fitting takes at most SAMPLE_TRUSTED and SAMPLE_UNLABELLED different vectors, chosen by their hash; copies of a text
count once. The prior is estimated on all different vectors of the table, the half that the first model is not fitted on. Labels of bad
documents are not used at all. Scoring covers every text whole.

Defined cases: a null or empty text has the zero vector and its score; a label without document, or a null label,
is not used; without trusted texts every score is 0; a null doc_id is never held out and never learned from as a
labelled row; repeated rows score alike. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .boosting import sigmoid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_TRUSTED, SAMPLE_UNLABELLED = 4000, 8000
FOLDS, HELD_FOLD = 3, 1
STEPS, RATE, L2 = 1500, 0.1, 1e-6
BINS = 400  # of the score, for the class prior
SURE = 0.1  # chance of error in the bounds of the prior
SLICE_BYTES = 1 << 22  # text that is measured at once; a longer one alone
BUCKETS = 256  # hashed words
STEPS_OF = 8  # steps into which a measure of the text is cut
GRAM = 5  # words of a repeated passage

# Classes of bytes; a byte that no list names is of class 0 (control characters).
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t",
    b"\n\r\x0b\x0c",
    b".,;:",
    b"!?",
    b"'\"-`",
    b"()[]{}<>",
    b"#$%&*@^~=+_",
    b"|/\\",
    bytes(range(0xC0, 0x100)),
    bytes(range(0x80, 0xC0)),
)
LOWER, UPPER, DIGIT, BLANK, LINE, STOP, CALL = 1, 2, 3, 4, 5, 6, 7
SYMBOL, BAR = 10, 11
KINDS = len(CLASSES) + 1
CLASS = np.zeros(256, np.uint8)
for _at, _members in enumerate(CLASSES, 1):
    CLASS[np.frombuffer(_members, np.uint8)] = _at
MEASURES = 14
WIDTH = KINDS * KINDS + BUCKETS + MEASURES * (1 + STEPS_OF)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[1], np.full(n - 1, 0x100000001B3)]).astype(np.uint64))


POWERS = _powers(4096)


def _distinct(owner: np.ndarray, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different values of each owner, and how often its most frequent one occurs."""
    if not len(owner):
        return np.zeros(n), np.zeros(n)
    with np.errstate(over="ignore"):
        key = (hashed ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    many = np.diff(np.append(first, len(key)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner[first], many)
    return np.bincount(owner[first], minlength=n).astype(float), top.astype(float)


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Vectors of texts, one byte a measure: texts are the bytes of ``data`` between neighbouring ``offsets``.

    Shares of pairs of byte classes, of hashed words, and measures of the text (length, words, repetition, lines,
    capitals, symbols) each as it is and cut into steps. Shares enter by their square root, times 255.
    """
    n, size = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((n, WIDTH), np.uint8)
    if not len(data):
        return out
    doc = np.repeat(np.arange(n), size)
    kind = CLASS[data]
    new = np.zeros(len(data), bool)
    new[offsets[:-1][size > 0]] = True
    share = np.zeros((n, KINDS * KINDS))
    inner = np.flatnonzero(~new[1:]) + 1
    if len(inner):
        pair = doc[inner] * (KINDS * KINDS) + kind[inner - 1].astype(np.int64) * KINDS + kind[inner]
        share = np.bincount(pair, minlength=n * KINDS * KINDS).reshape(n, -1) / np.maximum(size - 1, 1)[:, None]
    space = (kind == BLANK) | (kind == LINE)
    start = ~space
    start[1:] &= space[:-1] | new[1:]
    first = np.flatnonzero(start)
    words = np.bincount(doc[first], minlength=n).astype(float)
    many = np.maximum(words, 1)
    buckets, measures = np.zeros((n, BUCKETS)), np.zeros((n, MEASURES))
    lengths = np.log1p(size)
    if len(first):
        owner = doc[first]
        place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data)))) if first[0] == 0 else np.concatenate([np.zeros(first[0], np.int64), np.arange(first[0], len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))])
        with np.errstate(over="ignore"):
            low = np.where(kind == UPPER, data | 0x20, data).astype(np.uint64) + np.uint64(1)
            hashed = np.add.reduceat(np.where(space, np.uint64(0), low * POWERS[place & 4095]), first)
            mixed = (hashed ^ (hashed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        buckets = np.bincount(owner * BUCKETS + (mixed >> np.uint64(56)).astype(np.int64), minlength=n * BUCKETS).reshape(n, -1) / many[:, None]

        def of_words(flag: np.ndarray) -> np.ndarray:
            """Share of words with at least one such byte."""
            return np.bincount(owner[np.add.reduceat(flag.astype(np.int64), first) > 0], minlength=n) / many

        ink = np.add.reduceat((~space).astype(np.int64), first)
        last = kind[first + ink - 1]
        different, top = _distinct(owner, hashed, n)
        same = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
        upper, lower = np.add.reduceat((kind == UPPER).astype(np.int64), first), np.add.reduceat((kind == LOWER).astype(np.int64), first)
        measures[:, 2] = np.bincount(owner, ink, n) / many / 20
        measures[:, 3] = different / many
        measures[:, 4] = top / many
        measures[:, 5] = np.bincount(owner[1:][same], minlength=n) / many
        measures[:, 6] = np.bincount(owner[(upper > 1) & (lower == 0)], minlength=n) / many
        measures[:, 7] = of_words((kind == SYMBOL) | (kind == BAR))
        measures[:, 8] = np.bincount(owner[(last == STOP) | (last == CALL)], minlength=n) / many
        measures[:, 9] = np.bincount(owner[ink > 24], minlength=n) / many
        measures[:, 10] = of_words(kind == DIGIT)
        if len(first) >= GRAM:
            whole = owner[: len(owner) - GRAM + 1] == owner[GRAM - 1 :]
            with np.errstate(over="ignore"):
                passage = sum((mixed[k : len(mixed) - GRAM + 1 + k] * POWERS[7 * k + 1] for k in range(1, GRAM)), mixed[: len(mixed) - GRAM + 1])
            mine = owner[: len(whole)][whole]
            runs = np.bincount(mine, minlength=n)
            measures[:, 11] = 1 - _distinct(mine, passage[whole], n)[0] / np.maximum(runs, 1)
            measures[runs == 0, 11] = 0
    # Lines, by the bytes between line ends.
    begin = new.copy()
    begin[1:] |= kind[:-1] == LINE
    head = np.flatnonzero(begin)
    with np.errstate(over="ignore"):
        text_hash = np.add.reduceat(np.where(kind == LINE, np.uint64(0), (data.astype(np.uint64) + np.uint64(1)) * POWERS[(np.arange(len(data)) - np.repeat(head, np.diff(np.append(head, len(data))))) & 4095]), head)
    lines = np.bincount(doc[head], minlength=n)
    measures[:, 12] = 1 - _distinct(doc[head], text_hash, n)[0] / np.maximum(lines, 1)
    measures[:, 13] = np.log1p(lines) / np.maximum(lengths, 1)
    measures[:, 0], measures[:, 1] = lengths / 20, np.log1p(words) / 16
    measures = np.clip(measures, 0, 1)
    measures[size == 0] = 0
    step = np.minimum((measures * STEPS_OF).astype(np.int64), STEPS_OF - 1)
    steps = (step[:, :, None] == np.arange(STEPS_OF)).reshape(n, -1) * 0.5
    whole = np.concatenate([np.sqrt(share), np.sqrt(buckets), measures, steps], axis=1)
    out[:] = np.rint(255 * whole)
    out[size == 0] = 0
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x``: the vector of every text, as WIDTH bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.large_binary())
            _, ends, data = texts.buffers()
            ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1)
                rows = text_features(data[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
                made = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), made], names=["doc_id", "x"])
                at = to

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, x binary")


@dataclass
class Linear:
    """Weights of a vector's bytes (as parts of 1), and a shift."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(WIDTH))
    shift: float = -40.0

    def values(self, x: np.ndarray) -> np.ndarray:
        return x.astype(np.float32) @ (self.weights / 255).astype(np.float32) + self.shift


def vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def _descend(gradient, width: int) -> Linear:
    """Adam from zero; ``gradient`` takes weights and shift and gives theirs."""
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, STEPS + 1):
        g = gradient(w[:-1], w[-1])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return Linear(w[:-1], float(w[-1]))


def fit_telling(trusted: np.ndarray, unlabelled: np.ndarray) -> Linear:
    """Logistic regression of trusted against unlabelled texts, both classes with equal weight."""
    x = np.concatenate([trusted, unlabelled]).astype(np.float32) / 255
    y = np.concatenate([np.ones(len(trusted)), np.zeros(len(unlabelled))])
    weight = np.where(y == 1, 0.5 / len(trusted), 0.5 / len(unlabelled))

    def gradient(w: np.ndarray, b: float) -> np.ndarray:
        e = (sigmoid(x @ w.astype(np.float32) + b) - y) * weight
        return np.append(e.astype(np.float32) @ x + L2 * w, e.sum())

    return _descend(gradient, x.shape[1])


def fit_non_negative(trusted: np.ndarray, unlabelled: np.ndarray, prior: float) -> Linear:
    """Minimise the non-negative unbiased risk of a linear score."""
    p, u = trusted.astype(np.float32) / 255, unlabelled.astype(np.float32) / 255

    def gradient(w: np.ndarray, b: float) -> np.ndarray:
        fp, fu = p @ w.astype(np.float32) + b, u @ w.astype(np.float32) + b
        # The loss of a negative is log(1 + exp(f)), with slope sigmoid(f); of a positive log(1 + exp(-f)).
        bad = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        su, sp = sigmoid(fu) / len(u), prior * sigmoid(fp) / len(p)
        of_bad = np.append(su.astype(np.float32) @ u - sp.astype(np.float32) @ p, su.sum() - sp.sum())
        ridge = np.append(L2 * w, 0.0)
        if bad < 0:
            return ridge - of_bad
        good = -prior * sigmoid(-fp) / len(p)
        return np.append(good.astype(np.float32) @ p, good.sum()) + of_bad + ridge

    return _descend(gradient, p.shape[1])


def best_bin_prior(trusted: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of good texts among the unlabelled ones, from counts by rising score."""
    n, m = trusted.sum(), unlabelled.sum()
    if not n or not m:
        return 0.5
    above_t, above_u = np.cumsum(trusted[::-1])[::-1] / n, np.cumsum(unlabelled[::-1])[::-1] / m
    error = np.sqrt(np.log(4 / SURE) / (2 * m)) + np.sqrt(np.log(4 / SURE) / (2 * n))
    some = above_t > 0
    at = np.argmin((above_u[some] + error) / above_t[some])
    return float(np.clip(above_u[some][at] / above_t[some][at], 0.01, 0.99))


def held_out(id_col: str = "doc_id"):
    """Every third document by the CRC-32 of its id; its label is never learned from."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % FOLDS == HELD_FOLD, F.lit(False))


def _learned(sample: DataFrame, make) -> Linear | None:
    """Fit in one task on a bounded sample of ``x, good``; the driver gets the weights."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The order in which tasks delivered the rows does not matter.
        rows = sorted(r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        parts = [np.frombuffer(b"".join(x for x, good in rows if good == g), np.uint8).reshape(-1, WIDTH) for g in (1, 0)]
        if len(parts[0]) and len(parts[1]):
            model = make(*parts)
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tolist()]), pa.array([model.shift])], names=["weights", "shift"])

    row = sample.select("x", "good").coalesce(1).mapInArrow(learn, "weights array<double>, shift double").collect()
    return Linear(np.array(row[0].weights), row[0].shift) if row else None


def fit(known: DataFrame, labels: DataFrame) -> Linear:
    """Fit on the stored vectors ``doc_id, x`` of all documents and the labels of those not held out."""
    good = labels.where("doc_id is not null and quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).where(~held_out()).distinct()
    mixed = F.xxhash64("x").alias("h")
    trusted = stored(known.join(good, "doc_id").select(mixed, "x").dropDuplicates(["h"]).withColumn("good", F.lit(1)), "trusted-vectors")
    others = known.where(~held_out()).select(mixed, "x")
    # Different vectors by their hash: about twice as many as are wanted, then the first of those.
    share = min(1.0, 2 * SAMPLE_UNLABELLED / max(1, others.agg(F.approx_count_distinct("h", 0.02)).first()[0]))
    low = others.where(F.pmod(F.col("h"), F.lit(1 << 20)) < int(np.ceil(share * (1 << 20)))).dropDuplicates(["h"]).withColumn("good", F.lit(0))
    spread = F.xxhash64("h")  # apart from the choice above, and from the halves
    half = F.pmod(spread, F.lit(2))

    def sample(rows: tuple[DataFrame, DataFrame]) -> DataFrame:
        first = [r.orderBy(F.xxhash64("h", F.lit(2)), "h").limit(most) for r, most in zip(rows, (SAMPLE_TRUSTED, SAMPLE_UNLABELLED), strict=True)]
        return stored(first[0].unionAll(first[1]), "quality-sample")

    telling = _learned(sample((trusted.where(half == 0), low.where(half == 0))), fit_telling)
    if telling is None:
        return Linear()

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.minimum((sigmoid(telling.values(vectors(batch.column(1)))) * BINS).astype(np.int32), BINS - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at)], names=["h", "bin"])

    def counts(rows: DataFrame) -> np.ndarray:
        """Different vectors of the other half by score: BINS numbers."""
        placed = rows.where(half == 1).select("h", "x").mapInArrow(bins, "h long, bin int")
        found = placed.groupBy("h").agg(F.min("bin").alias("bin")).groupBy("bin").agg(F.count("*").alias("n")).collect()
        out = np.zeros(BINS)
        for r in found:
            out[r.bin] = r.n
        return out

    prior = best_bin_prior(counts(trusted), counts(others))
    model = _learned(sample((trusted, low)), lambda p, u: fit_non_negative(p, u, prior))
    return model or Linear()


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score. Every text is read once; its vector is stored."""
    known = stored(features(docs, id_col, text_col), "quality-vectors")
    model = fit(known, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(model.values(vectors(batch.column(1))).astype(np.float64)))], names=["doc_id", "score"])

    return known.mapInArrow(run, "doc_id long, score double")

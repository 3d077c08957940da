"""Toxicity: a linear-chain conditional random field over tokens, marginals, and a document score.

Only documents are labelled, so tokens get their labels first: word forms and word beginnings that toxic
documents hold far more often than clean ones mark their tokens in toxic documents (``telling_marks``). A chain
of two states (clean, toxic) is then fitted to these labels: each token's score sums hashed features of the word and its
neighbours (form, beginnings, ending), and a transition matrix links neighbouring states. Forward-backward
gives each token's marginal of being toxic. A document's evidence is the log odds that at least one token is
toxic (noisy-or over the marginals, as a sum); a logistic fit on training documents turns it into the score.

Fitting uses at most SAMPLE_DOCS labelled rows of any length, at most a third of them toxic, chosen by a hash
of the id. Marks are counted over the whole texts of that sample and the document fit sees the evidence of whole
texts; both are computed in many tasks. Scoring covers every text whole. The chain is fitted on windows of
FIT_TOKENS tokens from anywhere in a sampled text: all of them, or beyond FIT_WINDOWS with and FIT_WINDOWS without
a toxic token as many chosen by a hash and weighted by their share. So a text gives at most
2 x FIT_WINDOWS x FIT_TOKENS tokens (8,000), the sample 24 million.

Defined cases: a null or empty text has no evidence and gets the score of none; a label row without
document, or with a null label, is not used; without labels of both kinds every score is 0; a null doc_id
is never held out and never trained on; repeated rows score alike. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .boosting import sigmoid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_DOCS = 3000
TOXIC_PART = 3  # at most a third of the sample is toxic
MIN_PLACES, SHARE, SURE = 5, 20.0, 3.0
DIMS = 1 << 18
EPOCHS, RATE, L2 = 60, 0.3, 1e-7
FIT_TOKENS = 250  # tokens of a training chain; a longer text becomes several chains
KEPT_WORDS = 250_000
CHAINS = 2048  # training chains that are computed together
FIT_WINDOWS = 16  # training chains of a text with toxic tokens, and as many without
BLOCK = 64  # places of a chain that are multiplied together
SLICE_CHARS = 1 << 21  # texts whose chains are computed together
FOLDS = 5
ENDS = "0123456789" + "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def word_form(token: str) -> str:
    """Lower case, without marks and digits at the ends; a token of marks only is empty."""
    word = token.lower().strip(ENDS)
    return word if word.isalpha() else EDGE.sub("", word)


def marks_of(word: str) -> list[str]:
    """The form and the beginnings that may carry a token's label."""
    return ["=" + word, *[f"^{word[:n]}" for n in (3, 4, 5, 6) if len(word) > n]]


WIDE = 32  # a longer word is known by its first and last 16 characters
BEGINNINGS, ENDINGS = (2, 3, 4, 5, 6), (2, 3)
NONE = DIMS  # the slot of a feature that a word does not have; its weight is zero


def _slot(hashed: np.ndarray, kind: int) -> np.ndarray:
    """Place of a feature in the weights, by its kind and the hash of its characters."""
    with np.errstate(over="ignore"):
        x = (hashed + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(DIMS)).astype(np.int64)


def feature_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of many words: at their own place (form, beginnings, endings), and their form as the
    word before and as the word after."""
    known = [w if len(w) <= WIDE else w[:16] + w[-16:] for w in words]
    size = np.fromiter(map(len, known), np.int64, len(known))
    width = max(int(size.max(initial=0)), max(BEGINNINGS))
    codes = np.array(known, f"U{width}").view(np.uint32).reshape(len(known), width).astype(np.uint64)
    prime, hashed = np.uint64(0x100000001B3), np.full(len(known), 0xCBF29CE484222325, np.uint64)
    own = []
    with np.errstate(over="ignore"):
        for i in range(width):
            hashed = np.where(i < size, (hashed ^ codes[:, i]) * prime, hashed)
            if i + 1 in BEGINNINGS:
                own.append(np.where(size > i, _slot(hashed, i + 1), NONE))
        rows = np.arange(len(known))
        for n in ENDINGS:
            end = np.zeros(len(known), np.uint64)
            for k in range(n):
                end = (end ^ codes[rows, np.maximum(size - n + k, 0)]) * prime
            own.append(np.where(size >= n, _slot(end, 20 + n), NONE))
    return np.stack([_slot(hashed, 30), *own], axis=1), _slot(hashed, 31), _slot(hashed, 32)


@dataclass
class Field:
    """A fitted chain: weights of hashed features for the toxic state, transition scores, and the document fit."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIMS + 1, np.float32))
    bias: float = -8.0
    links: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 0.0
    shift: float = -40.0


def chain_marginals(emission: np.ndarray, mask: np.ndarray, links: np.ndarray, with_pairs: bool = False, weight: np.ndarray | None = None):
    """Forward-backward for many chains at once, place by place.

    ``emission``: chains x places, the score of the toxic state against the clean one; ``mask``: the places
    that exist, a prefix of each row. Returns the marginals of the toxic state and, if asked for, the expected
    counts of the four transitions, each chain counted by its ``weight``. Messages are odds; scores are held within +-30, so nothing overflows.
    """
    n, places = emission.shape
    (a, b), (c, d) = np.exp(np.clip(links, -30, 30))
    e = np.where(mask, np.exp(np.clip(emission, -30, 30)), 1.0).T.copy()
    live = mask.T
    forward, backward = np.empty((places, n)), np.ones((places, n))
    forward[0] = e[0]
    for t in range(1, places):
        forward[t] = e[t] * (b + d * forward[t - 1]) / (a + c * forward[t - 1])
    for t in range(places - 2, -1, -1):
        right = e[t + 1] * backward[t + 1]
        backward[t] = np.where(live[t + 1], (c + d * right) / (a + b * right), 1.0)
    odds = forward * backward
    marginal = (odds / (1.0 + odds)).T
    if not with_pairs:
        return marginal
    left, right = forward[:-1], e[1:] * backward[1:]
    share = np.stack([np.full_like(left, a), b * right, c * left, d * left * right])
    share *= (live[1:] if weight is None else live[1:] * weight) / share.sum(0)
    return marginal, share.sum((1, 2)).reshape(2, 2)


def flat_marginals(emission: np.ndarray, lengths: np.ndarray, links: np.ndarray) -> np.ndarray:
    """Marginals of the toxic state for chains that lie one after the other.

    A place multiplies the message (weights of the two states) by a 2 x 2 matrix. Chains are cut into blocks
    of BLOCK places; the matrices of a block are multiplied for all blocks at once, the messages then go from
    block to block of each chain, forward and backward, and last through the places of all blocks at once.
    Nothing is approximated; a chain of n places takes about BLOCK + n / BLOCK steps instead of n.
    """
    blocks = -(-lengths // BLOCK)
    last = np.cumsum(blocks)
    first = last - blocks
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(emission)) - np.repeat(starts, lengths)
    at = (place % BLOCK, np.repeat(first, lengths) + place // BLOCK)
    shape = (BLOCK, int(blocks.sum()))
    e = np.exp(np.clip(emission, -30, 30))
    t = np.exp(links)
    # Missing places leave the message as it is; the first place of a chain has no transition.
    n00, n01, n10, n11 = np.ones(shape), np.zeros(shape), np.zeros(shape), np.ones(shape)
    n00[at], n01[at], n10[at], n11[at] = t[0, 0], t[0, 1] * e, t[1, 0], t[1, 1] * e
    n00[0, first], n01[0, first], n10[0, first], n11[0, first] = 1.0, 0.0, 0.0, e[starts]
    p00, p01, p10, p11 = n00[0].copy(), n01[0].copy(), n10[0].copy(), n11[0].copy()
    for i in range(1, BLOCK):
        a, b, c, d = n00[i], n01[i], n10[i], n11[i]
        p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
        if i % 4 == 3:  # only ratios matter
            scale = 1.0 / np.maximum(np.maximum(p00, p01), np.maximum(p10, p11))
            p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    # Odds that enter each block from before and from behind.
    into, behind = np.ones(shape[1]), np.ones(shape[1])
    order = np.argsort(-blocks, kind="stable")
    longest = int(blocks.max(initial=0))
    many = np.searchsorted(-blocks[order], -np.arange(1, longest + 1), side="right")
    for k in range(1, longest):
        here = first[order[: many[k]]] + k
        f = into[here - 1]
        into[here] = (p01[here - 1] + p11[here - 1] * f) / (p00[here - 1] + p10[here - 1] * f)
        here = last[order[: many[k]]] - 1 - k
        g = behind[here + 1]
        behind[here] = (p10[here + 1] + p11[here + 1] * g) / (p00[here + 1] + p01[here + 1] * g)
    odds, f = np.empty(shape), into
    for i in range(BLOCK):
        f = (n01[i] + n11[i] * f) / (n00[i] + n10[i] * f)
        odds[i] = f
    g = behind
    for i in range(BLOCK - 1, -1, -1):
        odds[i] *= g
        g = (n10[i] + n11[i] * g) / (n00[i] + n01[i] * g)
    odds = odds[at]
    return odds / (1.0 + odds)


def fit_chain(chains: list[tuple[list[str], np.ndarray, float]]) -> Field:
    """Fit to token labels by gradient steps (Adagrad) on the exact log likelihood of (words, labels, weight)."""
    out = Field()
    places = max(len(w) for w, *_ in chains)
    n = len(chains)
    sizes = np.array([len(w) for w, *_ in chains])
    weight = np.array([v for *_, v in chains], float)
    y = np.zeros((n, places), np.int8)
    known: dict[str, int] = {}
    ids = np.zeros((n, places), np.int32)
    for i, (words, labels, _) in enumerate(chains):
        y[i, : len(words)] = labels
        ids[i, : len(words)] = [known.setdefault(w, len(known)) for w in words]
    own, before, after = feature_slots(list(known))
    flat, owner = own.ravel(), np.repeat(np.arange(len(own)), own.shape[1])
    size = DIMS + 1
    w = np.zeros(size)
    tokens = float(weight @ sizes)
    share = (float(weight @ y.sum(1)) + 1.0) / (tokens + 2.0)
    bias, links = float(np.log(share / (1 - share))), np.zeros((2, 2))
    seen_w, seen_rest = np.full(size, 1e-2), np.full(5, 1e-2)
    for _ in range(EPOCHS):
        at_word, at_before, at_after = w[own].sum(1), w[before], w[after]
        of_word, of_before, of_after = np.zeros(len(own)), np.zeros(len(own)), np.zeros(len(own))
        rest = np.zeros(5)
        for i in range(0, n, CHAINS):  # memory stays bounded whatever the sample
            part = slice(i, i + CHAINS)
            here, toxic, v = ids[part], y[part], weight[part][:, None]
            mask = np.arange(places) < sizes[part][:, None]
            pairs = mask[:, 1:]
            emission = at_word[here] + bias
            emission[:, 1:] += at_before[here[:, :-1]]
            emission[:, :-1] += np.where(pairs, at_after[here[:, 1:]], 0.0)
            marginal, expected = chain_marginals(emission, mask, links, with_pairs=True, weight=weight[part])
            miss = np.where(mask, toxic - marginal, 0.0) * v
            of_word += np.bincount(here.ravel(), miss.ravel(), len(own))
            of_before += np.bincount(here[:, :-1].ravel(), miss[:, 1:].ravel(), len(own))
            of_after += np.bincount(here[:, 1:].ravel(), np.where(pairs, miss[:, :-1], 0).ravel(), len(own))
            truth = [[float((((toxic[:, :-1] == a) & (toxic[:, 1:] == b) & pairs) * v).sum()) for b in (0, 1)] for a in (0, 1)]
            rest += [miss.sum(), *(np.array(truth) - expected).ravel()]
        grad = np.bincount(flat, of_word[owner], size)
        grad += np.bincount(before, of_before, size)
        grad += np.bincount(after, of_after, size)
        grad -= L2 * tokens * w
        grad[NONE] = 0.0
        seen_w += grad**2
        w += RATE * 3 * grad / np.sqrt(seen_w)
        seen_rest += rest**2
        step = RATE * rest / np.sqrt(seen_rest)
        bias += step[0]
        links += step[1:].reshape(2, 2)
    out.weights, out.bias, out.links = w.astype(np.float32), float(bias), links - links[0, 0]
    # Taking the score of clean-clean off all transitions changes no marginal.
    return out


def log_odds(p: np.ndarray) -> float:
    """Log odds that at least one token is toxic, by the marginals; -40 at least."""
    clean = float(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())  # log of the chance that all are clean
    return max(-40.0, float(np.log(-np.expm1(min(clean, -1e-18))) - clean))


class Scorer:
    """Emissions by word, remembered for words that were met before, and evidence by document."""

    def __init__(self, model: Field):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.kept: dict[str, int] = {}  # token -> row of its word form
        self.forms: dict[str, int] = {}
        self.table = np.empty((0, 3))  # scores at the own place, for the word after and for the word before

    def _add(self, tokens: list[str]) -> None:
        words = list(map(word_form, tokens))
        new = [w for w in dict.fromkeys(words) if w not in self.forms]
        if new:
            self.forms.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            own, before, after = feature_slots(new)
            w = self.model.weights.astype(np.float64)
            self.table = np.concatenate([self.table, np.stack([w[own].sum(1), w[before], w[after]], axis=1)])
        self.kept.update(zip(tokens, map(self.forms.__getitem__, words), strict=True))

    def marginals(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(text number, marginals of its tokens); texts without tokens are left out."""
        i = 0
        while i < len(texts):
            j, chars = i, 0
            while j < len(texts) and (j == i or chars + len(texts[j]) <= SLICE_CHARS):
                chars += len(texts[j])
                j += 1
            yield from self._slice(texts[i:j], i)
            i = j

    def _slice(self, texts: list[str], number: int) -> Iterator[tuple[int, np.ndarray]]:
        if len(self.kept) > KEPT_WORDS:
            self.clear()
        tokens, lengths = [], []
        for text in texts:
            mine = text.split()
            tokens += mine
            lengths.append(len(mine))
        new = [t for t in dict.fromkeys(tokens) if t not in self.kept]
        if new:
            self._add(new)
        if not tokens:
            return
        table = self.table
        words = np.fromiter(map(self.kept.__getitem__, tokens), np.int64, len(tokens))
        lengths = np.array(lengths, np.int64)
        ends = np.cumsum(lengths)
        emission = table[words, 0] + self.model.bias
        inner = np.ones(len(tokens), bool)
        inner[(ends - lengths)[lengths > 0]] = False  # the first token of a text has none before it
        emission[inner] += table[words[np.flatnonzero(inner) - 1], 1]
        emission[np.flatnonzero(inner) - 1] += table[words[inner], 2]
        full = np.flatnonzero(lengths > 0)
        p = flat_marginals(emission, lengths[full], self.model.links)
        for i in full.tolist():
            yield number + i, p[ends[i] - lengths[i] : ends[i]]

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Log odds that some token is toxic; -40 where there is none."""
        out = np.full(len(texts), -40.0)
        for i, p in self.marginals(texts):
            out[i] = log_odds(p)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.model.slope * self.evidence(texts) + self.model.shift)


def held_out(id_col: str = "doc_id"):
    """Every fifth document by the CRC-32 of its id; its label is never learned from."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Fit on the labelled documents that are not held out: a sample of at most SAMPLE_DOCS rows."""
    truth = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fitting = ~held_out(id_col)
    ids = docs.where(fitting).select(F.col(id_col).cast("long").alias("doc_id")).distinct().join(truth, "doc_id")
    mixed = F.xxhash64("doc_id")
    most = (SAMPLE_DOCS - SAMPLE_DOCS // TOXIC_PART, SAMPLE_DOCS // TOXIC_PART)
    # Two bounded top lists; a class that has fewer rows leaves the rest unused.
    chosen = [ids.where(F.col("toxic") == t).orderBy(mixed, "doc_id").limit(most[t]).select("doc_id", "toxic") for t in (0, 1)]
    wanted = stored(chosen[0].unionAll(chosen[1]), "toxicity-sample")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # One row per id, so a repeated document counts once. At most SAMPLE_DOCS ids are broadcast.
    one = narrow.join(F.broadcast(wanted), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").cast("int").alias("toxic"))
    sample = stored(one.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic"), "toxicity-texts")
    if sample.agg(F.count_distinct("toxic")).first()[0] < 2:
        return Field()
    telling = telling_marks(sample)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                parts = training_parts(*(batch.column(i)[at].as_py() for i in range(3)), telling)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 1),
                        pa.array([["\n".join(words) for words, *_ in parts]], pa.list_(pa.string())),
                        pa.array([[labels.astype(np.int8).tobytes() for _, labels, _ in parts]], pa.list_(pa.binary())),
                        pa.array([[weight for *_, weight in parts]], pa.list_(pa.float64())),
                    ],
                    names=["doc_id", "words", "labels", "weights"],
                )

    parts = stored(sample.mapInArrow(cut, "doc_id long, words array<string>, labels array<binary>, weights array<double>"), "toxicity-chains")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The order in which tasks delivered the texts does not matter.
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: r[0])
        one: dict[str, str] = {}  # one string for all places of a word
        chains = [
            ([one.setdefault(w, w) for w in words.split("\n")], np.frombuffer(labels, np.int8), weight)
            for row in rows
            for words, labels, weight in zip(*row[1:], strict=True)
        ]
        if chains:
            model = fit_chain(chains)
            yield pa.RecordBatch.from_arrays(
                [pa.array([model.weights.tobytes()]), pa.array([[model.bias, *model.links.ravel().tolist()]])], names=["weights", "rest"]
            )

    # The bounded chains are fitted in one task; the driver gets the weights only.
    row = parts.coalesce(1).mapInArrow(learn, "weights binary, rest array<double>").collect()
    if not row:
        return Field()
    rest = row[0].rest
    model = Field(np.frombuffer(bytes(row[0].weights), np.float32), rest[0], np.array(rest[1:5]).reshape(2, 2))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scorer.evidence(part.column(1).to_pylist())), part.column(2)], names=["doc_id", "evidence", "toxic"])

    # Whole texts are judged where they lie; at most SAMPLE_DOCS numbers come back.
    judged = sorted(sample.select("doc_id", "text", "toxic").mapInArrow(judge, "doc_id long, evidence double, toxic int").collect())
    model.slope, model.shift = fit_evidence(np.array([r.evidence for r in judged]), np.array([r.toxic for r in judged], float))
    return model


def mark_hash(mark: str) -> int:
    return int.from_bytes(blake2b(mark.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def places_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (mark, word before) of some texts as hashes, and whether the mark is a whole form."""
    number: dict[str, int] = {"": 0}
    pairs = []
    for text in texts:
        words = list(map(word_form, text.split()))
        own = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        pairs.append(np.unique(own << 32 | np.concatenate([[0], own])[: len(own)]))
    pairs = np.unique(np.concatenate([np.empty(0, np.int64), *pairs]))
    pairs = pairs[pairs >> 32 > 0]  # not of the empty word
    marks = [list(map(mark_hash, marks_of(w))) if w else [] for w in number]
    first = np.cumsum([0, *map(len, marks)])
    flat = np.array([m for ms in marks for m in ms], np.int64)
    form = np.array([mark_hash("=" + w) for w in number], np.int64)
    own, before = pairs >> 32, pairs & 0xFFFFFFFF
    many, out, whole = np.diff(first)[own], [], []
    for k in range(int(many.max(initial=0))):  # the form, then beginnings of rising length
        has = many > k
        out.append(np.stack([flat[first[own[has]] + k], form[before[has]]]))
        whole.append(np.full(out[-1].shape[1], k == 0))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    mark, before = np.concatenate(out, axis=1)
    return mark, before, np.concatenate(whole)


def telling_marks(sample: DataFrame) -> frozenset[int]:
    """Word forms and beginnings (as hashes) that toxic documents hold and clean ones do not.

    What counts is the number of different words a mark follows, so the copies of a document count once. A
    mark is telling if it is SHARE times as frequent in toxic documents, at MIN_PLACES places at least, and so
    by far that chance would not bring it about for any of all the marks. Whole texts are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in (0, 1):
                mine = [x for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if y == t]
                ends = np.cumsum(list(map(len, mine))) // SLICE_CHARS
                for at in np.unique(ends):
                    mark, before, form = places_of([x for x, e in zip(mine, ends, strict=True) if e == at])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mark), pa.array(before), pa.array(form), pa.array(np.full(len(mark), t, np.int32))], names=["mark", "before", "form", "toxic"]
                    )

    found = sample.select("text", "toxic").mapInArrow(run, "mark long, before long, form boolean, toxic int")
    once = found.groupBy("mark", "before", "form").agg(F.max(1 - F.col("toxic")).alias("c"), F.max("toxic").alias("k"))
    counts = stored(once.groupBy("mark", "form").agg(F.sum("c").cast("double").alias("c"), F.sum("k").cast("double").alias("k")), "toxicity-marks")
    # Forms stand for the different (word, word before) pairs.
    total = counts.agg(
        (F.coalesce(F.sum(F.when(F.col("form"), F.col("c"))), F.lit(0.0)) + 1).alias("c"),
        (F.coalesce(F.sum(F.when(F.col("form"), F.col("k"))), F.lit(0.0)) + 1).alias("k"),
        F.count_if(F.col("k") > 0).alias("marks"),
    ).first()
    expected = total.k / (total.c + total.k)
    chance = float(np.log(total.marks + 1) + SURE)
    k, c = F.col("k"), F.col("c")
    gain = k * F.log(k / (k + c) / expected) + F.when(c > 0, c * F.log(c / (k + c) / (1 - expected))).otherwise(0.0)
    telling = counts.where((k >= MIN_PLACES) & (k / total.k >= SHARE * c / total.c)).where(gain >= chance)
    return frozenset(r.mark for r in telling.select("mark").collect())


def training_parts(doc_id: int, text: str, toxic: int, telling: frozenset[int]) -> list[tuple[list[str], np.ndarray, float]]:
    """Training chains of a text: words, their labels, weight.

    The windows of the whole text, those with and those without a toxic token apart; of each kind at most
    FIT_WINDOWS, chosen by a hash and weighted by their share, so that the chains stand for the whole text.
    """
    words = list(map(word_form, text.split()))
    hot = {w for w in set(words) if w and not telling.isdisjoint(map(mark_hash, marks_of(w)))} if toxic else set()
    labels = np.array([w in hot for w in words], bool)
    starts: tuple[list[int], list[int]] = ([], [])
    for i in range(0, len(words), FIT_TOKENS):
        starts[int(labels[i : i + FIT_TOKENS].any())].append(i)
    chains = []
    for every in starts:
        chosen = sorted(sorted(every, key=lambda i: mark_hash(f"{doc_id}:{i}"))[:FIT_WINDOWS])
        chains += [(words[i : i + FIT_TOKENS], labels[i : i + FIT_TOKENS], len(every) / len(chosen)) for i in chosen]
    return chains


def fit_evidence(evidence: np.ndarray, t: np.ndarray) -> tuple[float, float]:
    """The document fit: one-dimensional logistic regression on the evidence, with a little regularisation."""
    slope, shift = 1.0, 0.0
    for _ in range(100):
        p = sigmoid(slope * evidence + shift)
        w = p * (1 - p) + 1e-9
        grad = np.array([((p - t) * evidence).sum() + 0.1 * (slope - 1), (p - t).sum() + 0.1 * shift])
        hess = np.array([[(w * evidence**2).sum() + 0.1, (w * evidence).sum()], [(w * evidence).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(hess, grad)
        scale = min(1.0, 1.0 / max(1e-9, np.abs(step).max()))
        slope, shift = slope - float(scale * step[0]), shift - float(scale * step[1])
    return max(slope, 0.0), shift


def score(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, spans (code-point offsets and marginals of toxic tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = [t or "" for t in part.column(1).to_pylist()]
                evidence, spans = np.full(len(texts), -40.0), [[] for _ in texts]
                for i, p in scorer.marginals(texts):
                    evidence[i] = log_odds(p)
                    hot = np.flatnonzero(p >= 0.5)
                    if len(hot):
                        places = [m.span() for m in re.finditer(r"\S+", texts[i])]
                        if len(places) == len(p):
                            spans[i] = [{"start": places[j][0], "stop": places[j][1], "p": float(p[j])} for j in hot]
                value = sigmoid(model.slope * evidence + model.shift)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, spans array<struct<start: long, stop: long, p: double>>")


def keep_clean(docs: DataFrame, model: Field, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns; whole rows stay in their task."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                clean = scorer.scores([t or "" for t in part.column(place).to_pylist()]) < threshold
                yield part.filter(pa.array(clean))

    return docs.mapInArrow(run, schema)

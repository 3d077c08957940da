"""Sampled piece segmentations: forward filtering and backward sampling over the lattice of pieces.

A text's lattice has an arc for every vocabulary piece that matches at a place, and one byte arc for each
character that no piece covers. With arc weight exp(score), the forward pass gives the mass of all ways to
reach a place; going back from the end, an arc is drawn with its share of the mass. So a segmentation is
drawn with probability proportional to the product of its weights. The random numbers are a hash of the row
key and the place of the choice, so the same row gives the same pieces on any cluster and after any retry.

The vocabulary holds merges in rank order, not log-probabilities; a piece of rank r gets the weight
exp(-temperature * log(r + RANK_SHIFT)) (Zipf), documented parameters. No piece of the vocabulary mixes letters
with other characters or goes on after a space (checked when it is read), so the lattice falls apart into
words, and words at places that no piece spans; the forward pass of a word is kept for the next time it occurs. Parts
of words are drawn for a whole batch of texts in steps of one arc. A text of any length without spaces costs no more a character.

Defined cases: null text counts as empty and has no pieces; a null row key counts as 0; repeated rows draw
the same pieces; characters outside the vocabulary, line ends and the space mark itself become byte pieces, so
decoding is lossless for every string.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from itertools import repeat
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
TEMPERATURE = 1.0
RANK_SHIFT = 10.0
KEPT_WORDS = 250_000
KEPT_ARCS = 6_000_000
BYTES_WEIGHT = -20.0
SLICE_CHARS = 1 << 20
STEPS = 64  # places of a part that the forward pass takes for many parts at once
# Letters and other characters (a raised 2 among them) apart, spaces with what follows them, line ends alone.
WORD = re.compile(r" *[^\W\d_²]+| *(?:[\d_²]|[^\w \n])+|\n| +")


class Vocabulary:
    """The pieces of a model as a tree of characters in sorted arrays, so that many places are matched at once."""

    def __init__(self, model_path: str, temperature: float = TEMPERATURE):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.byte_id: dict[int, int] = {}
        self.bytes_of: list[bytes] = [b""] * size
        pieces = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i)):
                pieces.append((piece, i))
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        if any(len(WORD.findall(p.replace(SPACE, " "))) > 1 for p, _ in pieces):
            raise ValueError("a piece of this vocabulary spans two words")
        self.longest = max((len(p) for p, _ in pieces), default=1)
        alphabet = sorted({c for p, _ in pieces for c in p})
        number = {c: i for i, c in enumerate(alphabet)}
        self.letters = len(alphabet)
        self.char = np.full(0x110000, -1, np.int32)
        self.char[[ord(c) for c in alphabet]] = np.arange(len(alphabet))
        # The space is written as the mark; the mark itself must not read as a space.
        self.char[ord(" ")], self.char[ord(SPACE)] = self.char[ord(SPACE)], -1
        edges: dict[int, int] = {}
        ids, scores = [-1], [0.0]
        for rank, (piece, i) in enumerate(pieces, 1):
            node = 0
            for c in piece:
                node = edges.setdefault(node * self.letters + number[c], len(edges) + 1)
                if node == len(ids):
                    ids.append(-1)
                    scores.append(0.0)
            ids[node], scores[node] = i, -temperature * log(rank + RANK_SHIFT)
        self.keys = np.array(sorted(edges), np.int64)
        self.child = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.ids, self.scores = np.array(ids, np.int64), np.array(scores)

    def arcs(self, chars: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All arcs (begin, length, id, score) over code points ``chars``, none beyond ``stop`` of its place, longer ones first."""
        code = self.char[chars].astype(np.int64)
        at, state = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        found = []
        for length in range(1, self.longest + 1):
            here = (at + length <= stop[at]) & (code[np.minimum(at + length - 1, len(code) - 1)] >= 0)
            at, state = at[here], state[here]
            if not len(at):
                break
            key = state * self.letters + code[at + length - 1]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            match = self.keys[edge] == key
            at, state = at[match], self.child[edge[match]]
            whole = self.ids[state] >= 0
            found.append((at[whole], np.full(whole.sum(), length), self.ids[state[whole]], self.scores[state[whole]]))
        bare = np.ones(len(chars), bool)
        if found:
            bare[found[0][0]] = False
        odd = np.flatnonzero(bare)
        # No piece for these characters: their bytes, as one arc with the number of the character.
        found.append((odd, np.ones(len(odd), np.int64), -1 - chars[odd].astype(np.int64), np.full(len(odd), BYTES_WEIGHT)))
        return tuple(np.concatenate(x) for x in zip(*reversed(found), strict=True))


class Rows:
    """Columns of numbers that grow together."""

    def __init__(self, *kinds: type):
        self.size, self.room = 0, [np.empty(1 << 16, k) for k in kinds]

    def append(self, *new: np.ndarray) -> None:
        size = self.size + len(new[0])
        if size > len(self.room[0]):
            more = max(size - len(self.room[0]), len(self.room[0]) // 4)
            self.room = [np.concatenate([x, np.empty(more, x.dtype)]) for x in self.room]
        for x, rows in zip(self.room, new, strict=True):
            x[self.size : size] = rows
        self.size = size

    def __getitem__(self, column: int) -> np.ndarray:
        return self.room[column][: self.size]


class Lattices:
    """Piece lattices of the words met so far, in flat arrays.

    A word is cut at every place that no piece spans; all ways lead through such a place, so its parts are
    drawn by themselves. ``parts`` holds the last node and the length of each part, ``nodes`` the first arc into each node,
    ``arcs`` the cumulated share, piece id and length of each arc, the longest into a node first.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.words = Rows(np.int64, np.int64)  # first part, number of parts
        self.parts = Rows(np.int64, np.int64)
        self.nodes = Rows(np.int64)
        self.arcs = Rows(np.float64, np.int32, np.int32)

    def add(self, words: list[str]) -> None:
        """Forward pass over words, all of their parts a place further at a time."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        begin, length, ids, score = self.vocabulary.arcs(chars, np.repeat(first + lengths, lengths))
        # Each word has a node before its first character and one after each.
        size = len(chars) + len(words)
        tail = begin + word[begin]
        head = tail + length
        over = np.cumsum(np.bincount(tail + 1, minlength=size + 1) - np.bincount(head, minlength=size + 1))[:size]
        cut = over == 0
        last_cut = np.maximum.accumulate(np.where(cut, np.arange(size), 0))
        # By node, longer arcs first. All arcs into a node come from one part, so they have one depth.
        by_node = np.argsort(head, kind="stable")
        tail, head, length, ids, score = (x[by_node] for x in (tail, head, length, ids, score))
        depth = np.minimum(head - last_cut[tail], STEPS + 1).astype(np.int16)
        order = np.argsort(depth, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.bincount(depth, minlength=STEPS + 2))])
        share, mass = np.empty(len(tail)), np.zeros(size)
        for d in range(1, STEPS + 1):
            mine = order[steps[d] : steps[d + 1]]
            if not len(mine):
                continue
            to = head[mine]
            starts = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            counts = np.diff(np.append(starts, len(to)))
            value = mass[tail[mine]] + score[mine]
            top = np.maximum.reduceat(value, starts)
            weight = np.exp(value - np.repeat(top, counts))
            total = np.add.reduceat(weight, starts)
            share[mine] = weight / np.repeat(total, counts)
            # Shares compare ways within a part, so a part begins with no mass.
            mass[to[starts]] = np.where(cut[to[starts]], 0.0, top + np.log(total))
        far = order[steps[STEPS + 1] :]
        if len(far):
            share[far] = _far_shares(tail[far], head[far], score[far], mass, cut)
        counts = np.bincount(head, minlength=size)
        starts = np.cumsum(counts) - counts
        run = np.cumsum(share)
        run -= np.repeat(run[starts[counts > 0]] - share[starts[counts > 0]], counts[counts > 0])
        run[(starts + counts - 1)[counts > 0]] = 1.0
        # A part ends at a cut that has arcs into it; the node before a word has none.
        ends = np.flatnonzero(cut & (counts > 0))
        before = last_cut[ends - 1]
        of_word = np.searchsorted(first + np.arange(len(words)), ends, side="right") - 1
        parts = np.bincount(of_word, minlength=len(words))
        known = self.words.size
        self.words.append(self.parts.size + np.cumsum(parts) - parts, parts)
        self.parts.append(self.nodes.size + ends, ends - before)
        self.nodes.append(self.arcs.size + starts)
        self.arcs.append(run, ids, length)
        self.numbers.update(zip(words, range(known, known + len(words)), strict=True))


def _far_shares(tail: np.ndarray, head: np.ndarray, score: np.ndarray, mass: np.ndarray, cut: np.ndarray) -> list[float]:
    """Shares of the arcs into the far nodes of very long parts, node after node; arcs come in the order of ``head``.

    Few parts are that long, so a step of all of them together would hold a handful of arcs.
    """
    reached: dict[int, float] = {}
    starts = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])).tolist()
    stops = starts[1:] + [len(head)]
    near, scores, tails, heads, cuts = mass[tail].tolist(), score.tolist(), tail.tolist(), head.tolist(), cut[head].tolist()
    out: list[float] = []
    for i, j in zip(starts, stops, strict=True):
        values = [reached.get(tails[k], near[k]) + scores[k] for k in range(i, j)]
        top = max(values)
        weights = [exp(v - top) for v in values]
        total = sum(weights)
        out += [w / total for w in weights]
        reached[heads[i]] = 0.0 if cuts[i] else top + log(total)
    return out


def uniform(base: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) from a part's base number and the step: a 64-bit mixing hash."""
    with np.errstate(over="ignore"):
        x = base + np.uint64((step + 1) * 0x94D049BB133111EB & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x ^= x >> np.uint64(shift)
            x *= np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


def draw(lattices: Lattices, ends: np.ndarray, lengths: np.ndarray, keys: np.ndarray, places: np.ndarray):
    """Backward sampling for many parts at once: ids in reading order, and the number of pieces of each part.

    The random numbers follow from the row key, the place of the part in its text and the step.
    """
    first, (cum, ids, back) = lattices.nodes[0], (lattices.arcs[i] for i in range(3))
    with np.errstate(over="ignore"):
        base = keys * np.uint64(0x9E3779B97F4A7C15) + places * np.uint64(0xBF58476D1CE4E5B9)
    at, node, left = np.arange(len(ends)), ends, lengths
    taken, count = [], np.zeros(len(ends), np.int64)
    step = 0
    while len(at):
        u = uniform(base, step)
        arc = first[node]
        # The longest arc comes first and is mostly the likeliest, so few draws go on; the last sum is 1 and u is less.
        wait = np.flatnonzero(u >= cum[arc])
        while len(wait):
            arc[wait] += 1
            wait = wait[u[wait] >= cum[arc[wait]]]
        taken.append((at, ids[arc]))
        count[at] += 1
        step_back = back[arc]
        go = np.flatnonzero(left > step_back)
        at, base, node, left = at[go], base[go], (node - step_back)[go], (left - step_back)[go]
        step += 1
    out = np.empty(count.sum(), np.int64)
    last = np.cumsum(count) - 1  # the first arc drawn is the last piece of its part
    for step, (at, what) in enumerate(taken):
        out[last[at] - step] = what
    return out, count


def _spelled(vocabulary: Vocabulary, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expand character arcs to byte pieces; also how many pieces each arc became."""
    counts = np.ones(len(what), np.int64)
    odd = np.flatnonzero(what < 0)
    if not len(odd):
        return what, counts
    spelled = [[vocabulary.byte_id[b] for b in chr(int(-1 - c)).encode("utf-8", "surrogatepass")] for c in what[odd]]
    counts[odd] = [len(s) for s in spelled]
    flat = np.repeat(what, counts)
    begins = np.cumsum(counts) - counts
    for b, s in zip(begins[odd].tolist(), spelled, strict=True):
        flat[b : b + len(s)] = s
    return flat, counts


def _encode_slice(lattices: Lattices, keys: list[int], texts: list[str]) -> list[np.ndarray]:
    words, counts = [], []
    for text in texts:
        mine = WORD.findall(" " + text) if text else []
        words += mine
        counts.append(len(mine))
    if len(lattices.numbers) > KEPT_WORDS or lattices.arcs.size > KEPT_ARCS:
        lattices.clear()
    number = np.fromiter(map(lattices.numbers.get, words, repeat(-1)), np.int64, len(words))
    missing = np.flatnonzero(number < 0)
    if len(missing):
        lattices.add(list(dict.fromkeys(words[i] for i in missing.tolist())))
        number[missing] = [lattices.numbers[words[i]] for i in missing.tolist()]
    # From words to their parts, counted by text.
    parts = lattices.words[1][number]
    upto = np.concatenate([[0], np.cumsum(parts)])
    inside = np.arange(upto[-1]) - np.repeat(upto[:-1], parts)
    part = np.repeat(lattices.words[0][number], parts) + inside
    stops = upto[np.cumsum(np.array(counts, np.int64))]
    counts = np.diff(stops, prepend=0)
    key = np.repeat(np.array([k & ((1 << 64) - 1) for k in keys], np.uint64), counts)
    place = (np.arange(len(part)) - np.repeat(stops - counts, counts)).astype(np.uint64)
    what, pieces = draw(lattices, lattices.parts[0][part], lattices.parts[1][part], key, place)
    what, became = _spelled(lattices.vocabulary, what)
    # Pieces up to each arc, then up to each part, then up to each text.
    upto_arc = np.concatenate([[0], np.cumsum(became)])
    upto_part = upto_arc[np.concatenate([[0], np.cumsum(pieces)])]
    return np.split(what, upto_part[stops][:-1])


def encode_batch(lattices: Lattices, keys: list[int], texts: list[str]) -> list[np.ndarray]:
    """Sampled ids of each text. The text is read as if a space stood before it."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and (j == i or chars + len(texts[j]) <= SLICE_CHARS):
            chars += len(texts[j])
            j += 1
        out += _encode_slice(lattices, keys[i:j], texts[i:j])
        i = j
    return out


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of a segmentation: bytes of its pieces without the space put before it."""
    table = vocabulary.bytes_of
    return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "surrogatepass")[1:]


def encode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    temperature: float = TEMPERATURE,
    with_ids: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_pieces, ids_crc32, lossless and, if wanted, the sampled ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(Vocabulary(model_path, temperature))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = encode_batch(lattices, [k or 0 for k in part.column(0).to_pylist()], texts)
                columns = [
                    part.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([decode(lattices.vocabulary, x) == t for x, t in zip(ids, texts, strict=True)], pa.bool_()),
                ]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                    flat = pa.array(np.concatenate(ids), pa.int32())
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_pieces", "ids_crc32", "lossless", "ids"][: len(columns)])

    kind = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" + ", ids array<int>" * with_ids
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, kind)


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text from ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model_path)
        for batch in batches:
            texts = [decode(vocabulary, np.array(x, np.int64)) if x else "" for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")

"""Secret scans: fixed formats, and windows of high Shannon entropy in candidate strings.

Three formats are always reported (assign, access, hex). Beyond them, candidate strings (runs of the
base64 alphabet) are cut at each change of character class, and a window slides over every run of a class: lower,
upper, letters, digits, hex, alnum and base64, each with a threshold of its own. The entropy of a window follows from
incremental counts: one symbol enters, one leaves, and the sum of c*log2(c) changes by those two terms. Windows over
the threshold are merged to spans of kind ``entropy``, unless the allow-list knows the string.

Words have as many different letters as a random key, so letters need a second sign: the mean cost of their pairs, in
bits, by the counts of letter pairs in all texts of the table. A window is reported only if it costs more than halfway
between the mean of the texts and that of random letters. A run shorter than the window, but of 16 characters at
least, is one window if it mixes lower, upper and digits; thresholds follow the logarithm of its length. Digits alone
are reported in runs of 20 and more that do not count up; shorter ones are counters, times or card numbers.

Defined cases: null text counts as empty; offsets are code points, ends exclusive; overlapping spans of
different kinds are all reported; a null doc_id is carried along; each repeated row is scanned by itself. An
empty table gives an empty result. Without counts of pairs (``scan`` alone) letters are taken for words. Scanning is
linear in the text, so one very long text costs its length.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("assign", "access", "hex", "entropy")
WINDOW, SHORTEST = 20, 16
# Bits a window of a class must reach; at most log2(20) = 4.32 for 20 symbols (fixed values).
THRESHOLDS = {"lower": 3.4, "upper": 3.4, "letters": 3.6, "digits": 2.8, "hex": 3.0, "alnum": 3.6, "base64": 3.8}
OF_LETTERS = ("lower", "upper", "letters")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
LETTERS = re.compile(r"[A-Za-z]+([-_/=+][A-Za-z]+)*")
# What looks random and is no secret: identifiers, counters, digests named as such, and runs.
ALLOW = (
    re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I),
    re.compile(r"[0-9]{1,19}([-_][0-9]{1,19})*"),
    re.compile(r"(sha(1|224|256|384|512)|md5)[-_=][A-Za-z0-9+/_=-]+", re.I),
    re.compile(r"(.{1,4})\1+.{0,3}"),
)

SHORT_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed formats, leftmost and non-overlapping within a kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


class Pairs(NamedTuple):
    """Bits of each pair of letters (27 x 27, 0 is no letter), and the mean above which letters are not words."""

    costs: list[list[float]]
    limit: float


def pair_costs(counts: np.ndarray) -> Pairs:
    """From how often each pair of letters occurs; a pair without a letter costs nothing."""
    n = counts.reshape(27, 27)[1:, 1:].astype(float)
    bits = -np.log2((n + 1) / (n.sum(1, keepdims=True) + 26))
    usual = (n * bits).sum() / n.sum() if n.sum() else bits.mean()
    costs = np.zeros((27, 27))
    costs[1:, 1:] = bits
    return Pairs(costs.tolist(), float(usual + bits.mean()) / 2)


PLACE = np.zeros(256, np.int64)
PLACE[65:91] = PLACE[97:123] = np.arange(1, 27)


def count_pairs(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each pair of letters A-Z, in any case, occurs in all texts: 729 counts, added up per batch first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(729, np.int64)
            for text in batch.column(0).to_pylist():
                at = PLACE[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)]
                total += np.bincount(at[:-1] * 27 + at[1:], minlength=729)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(729)), pa.array(total)], names=["pair", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "pair long, n long")
    out = np.zeros(729, np.int64)
    for r in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r.pair] = r["n"]
    return out


def classes(run: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, class) of the parts of a candidate: split at symbols, each part by its narrowest class.

    A whole run with mixed symbols is of class base64 as well, and one of letter groups of class letters.
    """
    for m in re.finditer(r"[A-Za-z0-9]+", run):
        part = m.group()
        digits = any(c.isdigit() for c in part)
        letters = any(c.isalpha() for c in part)
        if digits and letters:
            yield m.start(), m.end(), "hex" if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", part) else "alnum"
        elif digits:
            yield m.start(), m.end(), "digits"
        else:
            yield m.start(), m.end(), "lower" if part.islower() else "upper" if part.isupper() else "letters"
    if re.search(r"[+/_=-]", run) and re.search(r"[0-9]", run) and re.search(r"[A-Z]", run) and re.search(r"[a-z]", run):
        yield 0, len(run), "base64"
    elif re.search(r"[+/_=-]", run) and LETTERS.fullmatch(run):
        yield 0, len(run), "letters"


def _enough(part: str, kind: str) -> bool:
    """Whether a part is long enough for its class."""
    if len(part) >= WINDOW:
        return True
    mixed = any(c.isdigit() for c in part) and any(c.islower() for c in part) and any(c.isupper() for c in part)
    return kind == "alnum" and len(part) >= SHORTEST and mixed


def _stepwise(part: str) -> bool:
    """Digits that count up or down."""
    return len({(int(b) - int(a)) % 10 for a, b in zip(part, part[1:], strict=False)}) == 1


def hot_windows(run: str, threshold: float, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Merged windows of ``run`` whose entropy reaches ``threshold``."""
    counts: dict[str, int] = {}
    total = 0.0  # sum of c * log2(c)
    begin = end = -1
    for i, entering in enumerate(run):
        c = counts.get(entering, 0)
        counts[entering] = c + 1
        total += SHORT_TERM[c + 1] - SHORT_TERM[c]
        if i >= window - 1:
            if math.log2(window) - total / window >= threshold:
                if i - window + 1 > end:
                    if begin >= 0:
                        yield begin, end
                    begin = i - window + 1
                end = i + 1
            leaving = run[i - window + 1]
            c = counts[leaving]
            counts[leaving] = c - 1
            total += SHORT_TERM[c - 1] - SHORT_TERM[c]
    if begin >= 0:
        yield begin, end


def unlike_words(run: str, pairs: Pairs, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Merged windows of ``run`` whose letter pairs cost more than words do on average; one enters, one leaves."""
    at = [ord(c) - 64 if "A" <= c <= "Z" else ord(c) - 96 if "a" <= c <= "z" else 0 for c in run]
    cost = [pairs.costs[a][b] for a, b in zip(at, at[1:], strict=False)]
    is_pair = [a > 0 and b > 0 for a, b in zip(at, at[1:], strict=False)]
    total, n, begin, end = 0.0, 0, -1, -1
    for i in range(len(cost)):
        total, n = total + cost[i], n + is_pair[i]
        if i >= window - 2:
            first = i - window + 2  # of the window's characters
            if total > (pairs.limit + 1e-6) * n and 2 * n >= window:
                if first > end:
                    if begin >= 0:
                        yield begin, end
                    begin = first
                end = i + 2
            total, n = total - cost[first], n - is_pair[first]
    if begin >= 0:
        yield begin, end


def _windows(part: str, kind: str, pairs: Pairs | None) -> Iterator[tuple[int, int]]:
    """Spans of a part that look random for its class."""
    window = min(WINDOW, len(part))
    threshold = THRESHOLDS[kind] * math.log2(window) / math.log2(WINDOW)
    if kind not in OF_LETTERS:
        yield from hot_windows(part, threshold, window)
    elif pairs is not None:
        for begin, end in unlike_words(part, pairs, window):
            yield from ((begin + a, begin + b) for a, b in hot_windows(part[begin:end], threshold, window))


def entropy_spans(text: str, pairs: Pairs | None = None) -> list[tuple[int, int, str]]:
    out = set()
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if any(a.fullmatch(run) for a in ALLOW):
            continue
        for start, end, kind in classes(run):
            part = run[start:end]
            if not _enough(part, kind) or any(a.fullmatch(part) for a in ALLOW) or (kind == "digits" and _stepwise(part)):
                continue
            for a, b in _windows(part, kind, pairs):
                out.add((m.start() + start + a, m.start() + start + b))
    # Overlapping spans of several classes become one.
    merged: list[list[int]] = []
    for a, b in sorted(out):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return [(a, b, "entropy") for a, b in merged]


def scan(text: str | None, pairs: Pairs | None = None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans and all spans of a text, each by start, then kind."""
    text = text or ""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text), key=order)
    return base, sorted([*base, *entropy_spans(text, pairs)], key=order)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPAN = "array<struct<kind: string, start: long, stop: long, base: boolean>>"


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (kind, start, stop, base), base_text and span_text (joined).

    Letter pairs are counted over all texts first, so the table is read twice.
    """
    pairs = pair_costs(count_pairs(docs, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            spans, base_text, all_text = [], [], []
            for text in batch.column(1):
                base, every = scan(text.as_py(), pairs)
                spans.append([{"kind": k, "start": a, "stop": b, "base": k != "entropy"} for a, b, k in every])
                base_text.append(joined(base))
                all_text.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, kind), pa.array(base_text), pa.array(all_text)],
                names=["doc_id", "spans", "base_text", "span_text"],
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id long, spans {SPAN}, base_text string, span_text string")


def mask(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind; overlapping spans are replaced together."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])

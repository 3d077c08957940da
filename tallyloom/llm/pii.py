"""Personal data: high-recall generators, boosted trees over format and context, calibrated thresholds.

Four formats are always reported (email, ip, card, phone). Generators propose further spans, overlapping and
far too many: spelled-out addresses, dotted numbers, IPv6 groups (with ``::`` too), digit chains with all kinds of separators,
numbers without a leading plus. For each kind boosted trees judge a span by its format (lengths, groups, separators,
digits) and context (neighbouring characters, cue words before it); a calibrated threshold per kind selects.

Nobody labels personal data here, so the trees learn from the formats: a proposed span that a format confirms is a
positive, also in weaker forms of itself (phone without the plus and country code, address spelled out, card with
other separators, IPv4 with its dots in brackets or words, IPv6 made from an IPv4). A negative is what a check
refutes: ``refuted`` (Luhn, parts over 255 or not four, no IPv6, prose around ``at``, dates, decimals and
identifiers for phones), a part of another kind's confirmed span, or a look-alike: a confirmed span's characters as
counts, scores, amounts, years, scope names or web sites, moved to another place of its text. Look-alikes pass the
checks, as do the spans that are judged later, so thresholds are calibrated on examples that no check refutes.
Other unconfirmed spans have no label and are only judged; what is refuted is never reported. The model is fitted on distinct spans, at most
SAMPLE_SPANS with equal parts for the kinds, from about SAMPLE_DOCS documents, chosen by a hash; every fifth, by a
hash of the text of its document, is held out. Scoring covers every text in one pass.

Defined cases: null text counts as empty; offsets are code points, ends exclusive; a null doc_id is carried
along; repeated rows are treated alike; with too few examples of a kind its trees select nothing and the
format stays. An empty table gives an empty result. All scanning is linear in the text.
"""

from __future__ import annotations

import ipaddress
import re
import sys
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .boosting import Boosted, fit
from .common import fresh

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, SAMPLE_SPANS = 20_000, 60_000
PRECISION = 0.97
CONTEXT = 24

DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Generators. Runs are bounded or delimited, so that no text makes them quadratic.
SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: ?@ ?| ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{1,63}(?:(?: ?\. ?| ?[\[(]dot[\])] ?| dot )[A-Za-z0-9-]{2,63})+"
)
DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,5}(?:\.[0-9]{1,5}){2,5}(?![0-9])")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
COMPRESSED = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\w:])")
SPELLED_IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| ?[\[(]dot[\])] ?| dot )[0-9]{1,3}){3}(?![0-9])")
CHAIN = re.compile(r"(?<![0-9])(?:\+|00)?\(?[0-9](?:[ ().\-/]{0,2}[0-9]){6,24}(?![0-9])")
SENTENCE = re.compile(r"(?: ?\.\s)[A-Za-z0-9-]")
DATE = re.compile(r"(?:19|20)[0-9]{2}([-/.])[01]?[0-9]\1[0-3]?[0-9](?![0-9])|[0-3]?[0-9]([-/.])[0-3]?[0-9]\2(?:19|20)[0-9]{2}(?![0-9])")
CUES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("tel", "phone", "call", "fax", "mobile"),
}
FEATURES = 25


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join([c for c in text if "0" <= c <= "9"])


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain: the local part is the run before the @."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed formats, leftmost and non-overlapping within a kind, failing ones dropped."""
    out = [(a, b, "email") for a, b in _emails(text)]
    out += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def proposals(text: str) -> list[tuple[int, int, str]]:
    """Overlapping candidate spans of all kinds."""
    out = []
    if "@" in text or " at " in text or "at)" in text or "at]" in text:
        out += [(m.start(), m.end(), "email") for m in SPELLED.finditer(text)]
    out += [(m.start(), m.end(), "ip") for m in DOTTED.finditer(text)]
    if ":" in text:
        out += [(m.start(), m.end(), "ip") for m in IPV6.finditer(text)]
    if "::" in text:
        out += [(m.start(), m.end(), "ip") for m in COMPRESSED.finditer(text) if m.end() - m.start() > 2]
    if "[.]" in text or "(.)" in text or "dot" in text:
        out += [(m.start(), m.end(), "ip") for m in SPELLED_IP.finditer(text)]
    for m in CHAIN.finditer(text):
        n = len(_digits(m.group()))
        if 12 <= n <= 19:
            out.append((m.start(), m.end(), "card"))
        if 7 <= n <= 15:
            out.append((m.start(), m.end(), "phone"))
    return out


def refuted(text: str, start: int, end: int, kind: str) -> bool:
    """Whether a check shows that a proposed span is not of its kind."""
    span = text[start:end]
    if kind == "card":
        return not luhn(_digits(span))
    if kind == "ip":
        if ":" in span:
            try:
                ipaddress.IPv6Address(span)
            except ValueError:
                return True
            return False
        parts = re.findall(r"[0-9]+", span)
        return len(parts) != 4 or any(int(p) > 255 for p in parts)
    if kind == "email":
        # A bare "at", and nothing but ends of sentences where the dots of the domain would be.
        domain = span.partition(" at ")[2]
        return "@" not in span and bool(domain) and "dot" not in domain and "." in domain and len(SENTENCE.findall(domain)) == domain.count(".")
    near = (_side(text, start - 1), _side(text, end))
    return (
        2 in near  # within an identifier
        or text[start - 1 : start] == "_"
        or text[end : end + 1] == "_"
        or len(set(_digits(span))) == 1
        or re.fullmatch(r"[0-9]+\.[0-9]+", span) is not None
        or DATE.match(span) is not None
    )


def _side(text: str, at: int) -> int:
    """Class of the character at a place: 0 none, 1 white space, 2 letter, 3 digit, 4 other."""
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of a span."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    before = text[max(0, start - CONTEXT) : start].lower()
    return [
        len(span),
        len(digits),
        len(groups),
        max(sizes),
        min(sizes),
        sizes[0],
        sizes[-1],
        sizes[len(sizes) // 2],
        span.count(" "),
        span.count("."),
        span.count("-"),
        span.count("(") + span.count(")"),
        span.count("/"),
        span.count(":"),
        span.startswith("+"),
        span.startswith("00"),
        "@" in span,
        "dot" in span or "[at]" in span or "(at)" in span,
        sum(c.isalpha() for c in span),
        len(set(digits)),
        _side(text, start - 1),
        _side(text, end),
        any(c in before for c in CUES[kind]),
        sum(len(g) == sizes[0] for g in groups),
        sum(int(b) - int(a) == 1 for a, b in zip(groups, groups[1:], strict=False)),
    ]


def _weaker(text: str, span: tuple[int, int, str]) -> list[tuple[str, int, int]]:
    """A confirmed span in forms that the fixed format would miss: text, start, end."""
    start, end, kind = span
    inside = text[start:end]
    if kind == "phone":
        bare = re.sub(r"^\+[0-9]{1,3}[ .-]?", "", inside)
        forms = [bare, "00" + inside[1:]] if len(_digits(bare)) >= 7 else ["00" + inside[1:]]
    elif kind == "email":
        forms = [inside.replace("@", " at ").replace(".", " dot "), inside.replace("@", " (at) ").replace(".", " (dot) "), inside.replace("@", " @ ")]
    elif kind == "card":
        digits = _digits(inside)
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        forms = [mark.join(groups) for mark in (".", "/", "  ", " -")]
    else:
        parts = inside.split(".")
        # Groups of an IPv6 address made from this one, and a run of them left out.
        made = [h.lstrip("0") or "0" for h in re.findall("....", blake2b(inside.encode(), digest_size=16).hexdigest())]
        first, last = 1 + int(made[0], 16) % 4, 1 + int(made[1], 16) % 3
        forms = ["[.]".join(parts), " dot ".join(parts), ":".join(made), ":".join(made[:first]) + "::" + ":".join(made[-last:])]
    return [(text[max(0, start - 64) : start] + f + text[end : end + 64], min(64, start), min(64, start) + len(f)) for f in forms]


def _look_alikes(text: str, span: tuple[int, int, str]) -> list[tuple[str, int, int]]:
    """Forms that pass the checks of a confirmed span's kind and are something else: text, start, end.

    They stand in another place of the text, so the cues of the span do not come along."""
    start, end, kind = span
    inside = text[start:end]
    d = _digits(inside)
    if kind == "phone":
        first = int(d[-1])
        forms = [
            " ".join(d[:10]),
            " ".join(str(first + i) for i in range(8)),
            " ".join(f"{d[i]}-{d[i + 1]}" for i in range(0, 10, 2)),
            f"{d[-2:]} {d[2:5]} {d[5:8]}",
            f"{d[-1]} {d[1:4]} {d[4:7]} {d[-3:]}",
            f"19{d[-2:]}-20{d[-4:-2]}",
            f"{d[-3:]}-{d[-3:-1]}{d[0]} {d[1:3]}-{d[3:5]}",
        ]
    elif kind == "card":
        # The digits and so their check sum stay; counts, scores and amounts instead of groups of a card.
        cuts = [(1,) * len(d), (1,) + (3,) * (len(d) // 3), (2, 1) * (len(d) // 3 + 1), (5, 2) * (len(d) // 7 + 1)]
        forms = [" ".join(_parts(d, sizes)) for sizes in cuts] + ["-".join(_parts(d, (2, 1) * (len(d) // 3 + 1)))]
    elif kind == "email":
        domain = inside.partition("@")[2]
        forms = [f"{word} at {domain}" for word in ("us", "look", "found", "more")]
    else:
        name = [c for c in blake2b(inside.encode(), digest_size=32).hexdigest() if c.isalpha()]
        forms = ["".join(name[:n]) + "::" + "".join(name[n : 2 * n]) for n in (1, 2, 3, 4) if len(name) >= 2 * n] + [f"{d[:2]}::{d[-2:]}"]
    return [_moved(text, start, f) for f in forms]


def _moved(text: str, start: int, form: str) -> tuple[str, int, int]:
    """``form`` between words of the text, half its length away from ``start``: text, start, end."""
    place = (start + len(text) // 2) % max(1, len(text))
    before, after = text[max(0, place - 64) : place].rpartition(" ")[0], text[place : place + 64].partition(" ")[2]
    before += " " if before else ""
    return f"{before}{form} {after}", len(before), len(before) + len(form)


def _parts(digits: str, sizes: tuple[int, ...]) -> list[str]:
    """Digits in groups of the given sizes, as far as they go."""
    out, at = [], 0
    for n in sizes:
        out.append(digits[at : at + n])
        at += n
    return [p for p in [*out, digits[at:]] if p]


def examples(text: str) -> list[tuple[str, int, str, list[float], bool]]:
    """(kind, label, span, features, unrefuted) of a text's proposals, and of weaker forms and look-alikes of confirmed spans."""
    base = base_spans(text)
    out = []
    for start, end, kind in proposals(text):
        same = [b for b in base if b[2] == kind and b[0] < end and start < b[1]]
        other = [b for b in base if b[2] != kind and b[0] < end and start < b[1]]
        label, wrong = None, refuted(text, start, end, kind)
        if same:
            # Only a span that covers the confirmed one is an example; parts of it are neither.
            if any(start <= b[0] and end >= b[1] and end - start <= b[1] - b[0] + 2 for b in same):
                label = 1
        elif other or wrong:
            label = 0
        if label is not None:
            out.append((kind, label, text[start:end], features(text, start, end, kind), not wrong))
    for span in base:
        weak = _weaker(text, span)
        weak += [_moved(text, span[0], form[a:b]) for form, a, b in weak]  # without its cues
        for label, forms in ((1, weak), (0, _look_alikes(text, span))):
            for form, start, end in forms:
                if label or not refuted(form, start, end, span[2]):
                    out.append((span[2], label, form[start:end], features(form, start, end, span[2]), True))
    return out


def sampled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct examples of a sample of documents: kind, label, span, x, met (no check refutes it), fold (by a hash of the text)."""
    rows = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, rows))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = narrow.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = [(*e, zlib.crc32(t.encode("utf-8", "surrogatepass"))) for t in texts for e in examples(t)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([e[0] for e in found], pa.string()),
                    pa.array([e[1] for e in found], pa.int32()),
                    pa.array([e[2] for e in found], pa.string()),
                    pa.array([[float(v) for v in e[3]] for e in found], pa.list_(pa.float64())),
                    pa.array([e[4] for e in found], pa.bool_()),
                    pa.array([e[5] for e in found], pa.int64()),
                ],
                names=["kind", "label", "span", "x", "met", "doc"],
            )

    spans = some.mapInArrow(run, "kind string, label int, span string, x array<double>, met boolean, doc long")
    return spans.groupBy("kind", "label", "span", "x").agg(F.max("met").alias("met"), (F.min("doc") % 5).cast("int").alias("fold"))


def fit_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, Boosted]:
    """Trees per kind from a bounded sample: documents by a hash of their id, then distinct spans by a hash of themselves."""
    spans = stored(sampled(docs, id_col, text_col), "pii-spans")
    model = {}
    for kind in KINDS:
        order = spans.where(F.col("kind") == kind).orderBy(F.xxhash64("span", "x"), "label", "span", "x")
        mine = order.limit(SAMPLE_SPANS // len(KINDS)).select("label", "x", "met", "fold").collect()
        x = np.array([r.x for r in mine], float).reshape(len(mine), FEATURES)
        y = np.array([r.label for r in mine], np.int64)
        held, met = np.array([r.fold for r in mine], np.int64) == 0, np.array([r.met for r in mine], bool)
        model[kind] = fit(x, y, held, PRECISION, met)
    return model


def scan(texts: list[str], model: dict[str, Boosted]) -> list[tuple[list, list]]:
    """Base spans and all spans of each text; proposals of all texts are judged together."""
    base = [base_spans(t) for t in texts]
    more: list[list] = [[] for _ in texts]
    by_kind: dict[str, list] = {k: [] for k in KINDS}
    for i, text in enumerate(texts):
        known = set(base[i])
        for span in proposals(text):
            # What lies within a confirmed span of its kind adds nothing.
            if not any(b[2] == span[2] and b[0] <= span[0] and span[1] <= b[1] for b in known) and not refuted(text, *span):
                by_kind[span[2]].append((i, span))
    for kind, found in by_kind.items():
        if not found or not model[kind].trees:
            continue
        x = np.array([features(texts[i], s[0], s[1], kind) for i, s in found], float)
        for (i, span), p in zip(found, model[kind].probability(x), strict=True):
            if p >= model[kind].threshold:
                more[i].append(span)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    return [(b, sorted({*b, *m}, key=order)) for b, m in zip(base, more, strict=True)]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind; overlapping spans are replaced together."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: dict[str, Boosted] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base_text and span_text (kind:start:end, comma-joined)."""
    model = fit_model(docs, id_col, text_col) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = scan([t or "" for t in part.column(1).to_pylist()], model)
                columns = [part.column(0), pa.array([joined(b) for b, _ in found]), pa.array([joined(s) for _, s in found])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base_text", "span_text"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, base_text string, span_text string")


def redact(docs: DataFrame, model: dict[str, Boosted] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with personal data replaced in the text; ``n_chars``, if there, follows. Null texts stay null."""
    model = fit_model(docs, id_col, text_col) if model is None else model
    schema = docs.schema
    texts = fresh(docs, "clean_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raw = part.column(place).to_pylist()
                found = scan([t or "" for t in raw], model)
                clean = [t if t is None or not s else redacted(t, s) for t, (_, s) in zip(raw, found, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(clean, pa.string())], names=[*part.schema.names, texts])

    out = docs.mapInArrow(run, T.StructType([*schema.fields, T.StructField(texts, T.StringType())]))
    changed = out.withColumn(text_col, F.col(texts)).drop(texts)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length(text_col).cast(schema["n_chars"].dataType))
    return changed.select(*docs.columns)

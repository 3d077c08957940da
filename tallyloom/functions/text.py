"""Review text normalisation."""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from collections.abc import Sequence
from functools import reduce
from operator import or_

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions that run in Python workers travel with their code; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# White space as Unicode defines it, for use inside a character class.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Zero-width characters.
ZERO_WIDTH = r"[\u200b-\u200f\ufeff]"
# Anything outside ASCII, Latin-1 letters, plain typographic marks and pictographs, or the start of
# an HTML entity. Only such texts need the Unicode tables of the Python worker.
FOREIGN = r"[^\x00-\x7f\u00c0-\u00ff\u2010-\u2027\x{1f300}-\x{1faff}]"
ENTITY = "&[#A-Za-z]"
NEEDS_TABLES = f"{FOREIGN}|{ENTITY}"


def _plain(char: str) -> str:
    parts = unicodedata.normalize("NFKD", char)
    return "".join(c for c in parts if not unicodedata.combining(c))


# Lower-case Latin-1 letters whose base letter is one other character.
_PAIRS = [(c, _plain(c)) for c in map(chr, range(0xDF, 0x100)) if len(_plain(c)) == 1 and _plain(c) != c]
ACCENTED = "".join(c for c, _ in _PAIRS)
BASE = "".join(b for _, b in _PAIRS)


def strip_space(text: Column) -> Column:
    """Without outer white space. A text that begins and ends with a visible ASCII character has none and is left as it is."""
    clean = text.rlike(r"\A[!-~](?:[ -~]*[!-~])?\z")
    return F.when(clean, text).otherwise(F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", ""))


def trimmed(text: Column) -> Column:
    """``strip_space`` for long texts: only those that begin or end with white space meet the slow pattern."""
    edge = (F.substring(text, 1, 1).rlike(f"[{SPACE}]")) | (F.substring(text, -1, 1).rlike(f"[{SPACE}]"))
    return F.when(edge, strip_space(text)).otherwise(text)


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _needs_tables(text: Column) -> Column:
    """Both patterns by themselves, each behind a plain test that every such text passes."""
    return (~_is_ascii(text) & text.rlike(FOREIGN)) | (F.contains(text, F.lit("&")) & text.rlike(ENTITY))


def _fold_native(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


@F.pandas_udf(T.StringType())
def _normalize_with_tables(texts: pd.Series) -> pd.Series:
    def one(text):
        if text is None:
            return None
        text = re.sub(r"<[^>]+>", " ", html.unescape(text))
        text = re.sub(r"(?i)https?://\S+|www\.\S+", " ", text)
        text = re.sub(ZERO_WIDTH, "", text)
        return " ".join(re.findall(r"\w+", _plain(text.casefold())))

    return texts.map(one)


def _soft(text: str) -> str:
    return " ".join(re.sub(ZERO_WIDTH, "", html.unescape(text)).split()).casefold()


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def _found_with_tables(texts: pd.Series, quotes: pd.Series) -> pd.Series:
    def one(text, wanted):
        if text is None or wanted is None:
            return None
        whole = _soft(text)
        return [None if q is None else (_soft(q) in whole if q else text == "") for q in wanted]

    return pd.Series([one(t, w) for t, w in zip(texts, quotes)])


def normalize_text(text: Column) -> Column:
    """Text without markup, links, accents and punctuation, case-folded, single-spaced.

    Texts in the Latin-1 alphabet stay in the JVM; the rest go to Arrow batches, and the worker sees
    nulls in place of the former.
    """
    bare = F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, r"<[^>]+>", " ")).otherwise(text)
    linked = F.contains(text, F.lit("://")) | F.contains(F.lower(text), F.lit("www"))
    # Marks inside an address may hide it until they are gone.
    linked = linked | F.contains(text, F.lit("<"))
    bare = F.when(linked, F.regexp_replace(bare, f"(?i)https?://[^{SPACE}]+|www\\.[^{SPACE}]+", " ")).otherwise(bare)
    letters = F.translate(_fold_native(bare), ACCENTED, BASE)
    plain = F.regexp_replace(F.lower(bare), r"[^a-z0-9_]+", " ")
    native = F.trim(F.when(_is_ascii(text), plain).otherwise(F.regexp_replace(letters, r"[^\p{L}\p{N}_]+", " ")))
    hard = _needs_tables(text)
    return F.when(hard, _normalize_with_tables(F.when(hard, text))).otherwise(native)


def _soften(text: Column) -> Column:
    return F.trim(_fold_native(F.regexp_replace(text, f"[{SPACE}]+", " ")))


def quotes_need_tables(text: Column, quotes: Column) -> Column:
    """Whether the quotes of a text can be judged by the Unicode tables only."""
    bare = ~F.contains(text, F.lit("&"))
    unseen = F.exists(quotes, lambda q: ~F.coalesce((q != "") & F.contains(text, q) & bare, F.lit(False)))
    return unseen & (_needs_tables(text) | F.exists(quotes, _needs_tables))


def quotes_found(text: Column, quotes: Column) -> Column:
    """For each quote, whether the text holds it up to entities, white space and case.

    Accents count. An empty quote belongs to an empty text only. A quote that a text without entities holds as it stands is
    found before the text is softened or looked through for foreign letters.
    """
    hard = quotes_need_tables(text, quotes)
    whole = _soften(text)
    native = F.transform(
        quotes, lambda q: F.when(q == "", text == "").otherwise(F.contains(text, q) | F.contains(whole, _soften(q)))
    )
    return F.when(hard, _found_with_tables(F.when(hard, text), F.when(hard, quotes))).otherwise(native)


def text_hash(normalized: Column) -> Column:
    return F.sha1(normalized)


def word_count(normalized: Column) -> Column:
    """Words of a normalised text, which are parted by single blanks."""
    return F.when(normalized == "", 0).otherwise(F.size(F.split(normalized, " ")))


def few_words(normalized: Column, most: int) -> Column:
    """Whether ``word_count`` is at most ``most``, above zero; only the beginning of the text is read."""
    return F.substring_index(normalized, " ", most) == normalized


def matches(normalized: Column, pattern: str, stems: Sequence[str] = (), longest: int | None = None) -> Column:
    """Search with word boundaries and classes that know Unicode letters.

    Every text that matches holds one of the ``stems`` and has at most ``longest`` characters, so the other texts need not
    meet the pattern, which is many times slower than these tests.
    """
    found = normalized.rlike("(?U)" + pattern)
    if longest is not None:
        found = (F.length(normalized) <= longest) & found
    if stems:
        found = reduce(or_, [F.contains(normalized, F.lit(s)) for s in stems]) & found
    return found

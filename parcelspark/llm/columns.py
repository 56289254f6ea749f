"""Column expressions shared by the training-data operators. Null texts count as empty."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Separators of words: white space, or all of ASCII but letters and digits.
SPACE = r"[\x20\x09-\x0D]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _pieces(text: Column, separator: str) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator, -1), "")


def space_words(text: Column) -> Column:
    """Words between white space, unchanged."""
    return _pieces(text, SPACE)


def plain_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    return _pieces(lower_ascii(text), NO_WORD)


def squeezed(text: Column) -> Column:
    """``text`` without white space."""
    return F.translate(text, SPACE_CHARS, "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once a row, and only where this expression is reached."""
    return F.transform(F.array(value), body)[0]


def window_hashes(words: Column, size: int) -> Column:
    """A 64-bit hash of each ``size`` consecutive words, by start; empty where there are fewer words.

    Words are hashed once; hashes of twice as many words come from pairs, the last step may overlap.
    """
    hashes, have = F.transform(words, lambda w: F.xxhash64(w)), 1
    while have < size:
        step = min(have, size - have)
        hashes, have = _paired(hashes, step), have + step
    return F.when(F.size(words) >= size, F.slice(hashes, 1, F.greatest(F.size(words) - size + 1, F.lit(0)))) \
        .otherwise(F.array().cast("array<bigint>"))


def _paired(hashes: Column, step: int) -> Column:
    """A hash of each value and the one ``step`` places on."""
    return let(hashes, lambda v: F.transform(v, lambda h, i: F.xxhash64(h, F.get(v, i + step))))


def covered(spans: Column) -> Column:
    """Positions inside at least one of the spans (start, length), an array sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def step(acc: Column, s: Column) -> Column:
        upto = F.greatest(acc.upto, s.start.cast("long") + s.length)
        return F.struct((acc.n + upto - F.greatest(acc.upto, s.start.cast("long"))).alias("n"), upto.alias("upto"))

    return F.aggregate(spans, zero, step, lambda acc: acc.n)


def remainder_of_id(doc_id: Column, modulus: int) -> Column:
    """The split of documents into folds: crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus

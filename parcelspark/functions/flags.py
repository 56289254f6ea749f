"""Zero/one columns from booleans and from keyword search in text.

A condition that is NULL counts as false, so every flag is 0 or 1 and never NULL. Matching is case-sensitive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def contains_any(c: str | Column, words: Sequence[str]) -> Column:
    return any_of([as_column(c).contains(w) for w in words])


def has_word(c: str | Column, words: Sequence[str]) -> Column:
    return as_flag(contains_any(c, words))


def has_word_except(c: str | Column, words: Sequence[str], unless: Sequence[str]) -> Column:
    return as_flag(contains_any(c, words) & ~contains_any(c, unless))


def has_word_in_any(spec: dict[str, Sequence[str]]) -> Column:
    """True when any column of ``spec`` contains one of its words."""
    return as_flag(any_of([contains_any(c, words) for c, words in spec.items()]))


def true_unless_word(c: str | Column, words: Sequence[str]) -> Column:
    """0 when a word is found; 1 otherwise, also for NULL."""
    return F.lit(1) - has_word(c, words)


def has_word_weakly_negated(c: str | Column, word: str, negatives: Sequence[str]) -> Column:
    """The word is there and at least one negative phrase is not: only all negatives together undo the flag."""
    return as_flag(as_column(c).contains(word) & ~all_of([as_column(c).contains(n) for n in negatives]))


def is_missing(c: str | Column, none_words: Sequence[str] = ()) -> Column:
    condition = as_column(c).isNull()
    if none_words:
        condition = condition | as_column(c).isin(list(none_words))
    return as_flag(condition)


def none_set(flags: Sequence[str]) -> Column:
    """1 when every flag is 0."""
    return as_flag(F.greatest(*[F.col(f) for f in flags]) == 0 if len(flags) > 1 else F.col(flags[0]) == 0)

"""Derived columns: ordered keyword categories, code initials, bands, flags, labelled points.

Everything here is a Column expression that stays inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Sequence[tuple[str, Sequence[str]]]

# Title -> keywords, tested in this order, first hit wins.
TITLE_RULES: Rules = (
    ("Officer", ("Capt", "Col", "Major", "Dr", "Rev")),
    ("Royalty", ("Jonkheer", "Don", "Sir", "the Countess", "Dona", "Lady")),
    ("Mrs", ("Mme", "Ms", "Mrs")),
    ("Miss", ("Mlle",)),
    ("Mr", ("Mr",)),
    ("Master", ("Master",)),
)
TITLE_OTHERWISE = "Anyone"

# Upper ends of the age bands 0..6; an age above the last, or not above 0, is band 7.
AGE_BAND_ENDS = (11, 21, 31, 41, 51, 61, 71)
# Upper ends of the fare bands 0..2; a fare above the last, or below 0, is band 3.
FARE_BAND_ENDS = (8, 15, 32)


def first_match(text: str | Column, rules: Rules, otherwise: str, match: str = "substring") -> Column:
    """The category of the first rule with a keyword in ``text``; null text gives ``otherwise``.

    ``match="substring"`` is case-sensitive containment anywhere ("Col" is found in "Colvin");
    ``match="word"`` asks for the keyword as a whole word.
    """
    column = F.col(text) if isinstance(text, str) else text
    if match == "substring":
        tests = [reduce(lambda a, b: a | b, [column.contains(k) for k in words]) for _, words in rules]
    elif match == "word":
        tests = [column.rlike(r"\b(?:" + "|".join(map(re.escape, words)) + r")\b") for _, words in rules]
    else:
        raise ValueError(f"match must be 'substring' or 'word', not {match!r}")
    chain = F
    for (category, _), test in zip(rules, tests, strict=True):
        chain = chain.when(test, F.lit(category))
    return chain.otherwise(F.lit(otherwise))


def title_of(name: str | Column, match: str = "substring") -> Column:
    """The title group of a person's name."""
    return first_match(name, TITLE_RULES, TITLE_OTHERWISE, match)


def code_initial(code: str | Column, missing: str = "U") -> Column:
    """First letter of a code, ``missing`` where there is none."""
    column = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.substring(column, 1, 1), F.lit(missing))


def size_band(size: Column, middle_to: int) -> Column:
    """1 below two, 2 up to ``middle_to`` (both ends included), 3 above."""
    return F.when(size < 2, 1).when(size <= middle_to, 2).otherwise(3)


def band(value: str | Column, ends: Sequence[float], low: float, low_open: bool = False) -> Column:
    """Number of the half-open band ``[end[i-1], end[i])`` holding ``value``, counted from ``low``.

    Values below ``low`` (or equal to it when ``low_open``), above the last end, NaN and null all
    get the number after the last band.
    """
    column = F.col(value) if isinstance(value, str) else value
    other = len(ends)
    chain = F.when((column <= low) if low_open else (column < low), other)
    for number, end in enumerate(ends):
        chain = chain.when(column < end, number)
    return chain.otherwise(other)


def age_band(age: str | Column) -> Column:
    """Eight age bands; 0, negative and 71 or more share the last one."""
    return band(age, AGE_BAND_ENDS, low=0, low_open=True)


def fare_band(fare: str | Column) -> Column:
    """Four fare bands; negative fares share the last one."""
    return band(fare, FARE_BAND_ENDS, low=0)


def flag_equals(column: str | Column, wanted: str) -> Column:
    """1.0 where equal, 0.0 elsewhere and for null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(value == wanted, 1.0).otherwise(0.0)


def dense_vector(*columns: str | Column) -> Column:
    """Numeric columns as one dense vector."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return array_to_vector(F.array(*[p.cast("double") for p in parts]))

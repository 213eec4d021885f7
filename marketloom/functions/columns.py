"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def int_or_default(c: Column, default: int = 0, strict: bool = False, to: str = "int") -> Column:
    """Text to integer; empty or missing text gives ``default``.

    ``strict=True`` raises on other bad text (ANSI cast), else it gives
    ``default`` as well.
    """
    text = blank_to_null(c)
    number = text.cast(to) if strict else text.try_cast(to)
    return F.coalesce(number, F.lit(default).cast(to))


def float_or_default(c: Column, default: float = 0.0, strict: bool = False) -> Column:
    text = blank_to_null(c)
    number = text.cast("double") if strict else text.try_cast("double")
    return F.coalesce(number, F.lit(default))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL on a zero denominator, in double precision."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def clamp(c: Column, low=None, high=None) -> Column:
    if low is not None:
        c = F.greatest(c, F.lit(low))
    if high is not None:
        c = F.least(c, F.lit(high))
    return c


def contains_any(c: Column, keywords: Sequence[str]) -> Column:
    """True where the text holds one of ``keywords`` as a substring."""
    return reduce(lambda a, b: a | b, (c.contains(k) for k in keywords))


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def keyword_hits(c: Column, keywords: Sequence[str]) -> Column:
    """How many different ``keywords`` occur in the text."""
    return reduce(lambda a, b: a + b, (flag(c.contains(k)) for k in keywords))


def keyword_score(c: Column, weights: Mapping[str, int]) -> Column:
    """Sum of the weights of the keywords that occur in the text."""
    terms = (F.when(c.contains(k), F.lit(w)).otherwise(F.lit(0)) for k, w in weights.items())
    return reduce(lambda a, b: a + b, terms)


def classify(c: Column, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label of the first rule one of whose keywords occurs in the text."""
    text = F.lower(text_or_empty(c))
    chain = None
    for label, keywords in rules:
        hit = contains_any(text, keywords)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def max_digit(c: Column) -> Column:
    """Largest single digit in the text, 0 without one."""
    digits = F.regexp_extract_all(text_or_empty(c), F.lit(r"\d"), F.lit(0))
    return F.coalesce(F.array_max(F.transform(digits, lambda d: d.cast("int"))), F.lit(0))


def hyphen_tokens(c: Column, stopwords: Sequence[str] = ()) -> Column:
    """Lower-case words of three or more letters, hyphens kept inside or at the end."""
    words = F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit(r"[a-z][a-z-]{2,}"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(list(stopwords))) if stopwords else words


def plain_tokens(c: Column, stopwords: Sequence[str] = (), min_length: int = 3) -> Column:
    """Words left after every character but ``a-z0-9`` and blank is removed."""
    cleaned = F.regexp_replace(F.lower(text_or_empty(c)), r"[^a-z0-9 ]", "")
    keep = lambda w: F.length(w) >= min_length
    if stopwords:
        keep = lambda w: (F.length(w) >= min_length) & ~w.isin(list(stopwords))
    # A single blank needs no pattern matching; the empty pieces are too short to stay.
    return F.filter(F.split(cleaned, " "), keep)


def thousands(c: Column, digits: int = 1) -> Column:
    """Number as text with thousands separators."""
    return F.format_number(c, digits)


def hash_order(seed: int, *ids: Column) -> Column:
    """Hex digest that puts rows in a repeatable random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[i.cast("string") for i in ids]))

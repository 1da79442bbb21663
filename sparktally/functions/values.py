"""Scalar column expressions: safe casts, field splitting, bands, synonyms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# The only words Java's parser takes for a double.
SPECIAL_NUMBERS = r"^[\x00-\x20]*[+-]?(NaN|Infinity)[\x00-\x20]*$"


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_double(col: Column | str) -> Column:
    """Parse a number; anything unparsable becomes NULL instead of failing.

    NULL is skipped by every aggregate, so a bad value counts in neither a
    sum nor a count. ``try_cast`` accepts ``4.0d`` and ``0x1p3`` as Java does,
    but also reads ``nan``, ``inf`` and ``infinity`` in any case; of these
    words only Java's own spellings count.
    """
    c = as_col(col)
    value = c.try_cast("double")
    word = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    # A number too large for a double is infinite without being a word. The
    # patterns are tried only where the cast gave no ordinary number.
    spelt = c.rlike(SPECIAL_NUMBERS) | ~c.rlike("(?i)n[af]")
    return F.when(value.isNull(), F.lit(None).cast("double")).when(~word, value).when(spelt, value)


def safe_int(col: Column | str) -> Column:
    """Parse an integer; ``'25.7'`` and ``'abc'`` become NULL."""
    return as_col(col).try_cast("int")


def strip_trailing(col: Column | str, sep: str) -> Column:
    """Remove a run of separators at the end of the text.

    Java's ``split`` drops trailing empty fields, Spark's keeps them; after
    this strip both give the same field list.
    """
    return F.rtrim(as_col(col), F.lit(_one_character(sep)))


def split_fields(col: Column | str, sep: str) -> Column:
    """Split like Java ``String.split(sep)``: trailing empty fields dropped.

    ``sep`` is a single literal character. An empty input gives ``['']``,
    which has one field, as in Java.
    """
    # A plain or escaped character is split without the regex engine.
    literal = _one_character(sep) if sep.isalnum() or sep.isspace() or ord(sep) > 126 else "\\" + sep
    return F.split(strip_trailing(col, sep), literal)


def bucketize(col: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Assign right-closed bands: ``x <= edges[0]`` -> labels[0], ...

    ``labels`` has one more entry than ``edges``; the last label takes every
    value above the last edge, NaN included (as an if/else chain would).
    NULL input gives NULL.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("bucketize needs len(labels) == len(edges) + 1")
    c = as_col(col)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        expr = expr.when(c <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def in_synonyms(col: Column | str, names: Sequence[str], exact: Sequence[str] = ()) -> Column:
    """True when the value equals one of ``names`` ignoring case, or one of
    ``exact`` as is (codes such as ``'1'``)."""
    c = as_col(col)
    upper = [n.upper() for n in names]
    test = F.upper(c).isin(upper) if upper else F.lit(False)
    if exact:
        test = test | c.isin(list(exact))
    return test


def _one_character(sep: str) -> str:
    if len(sep) != 1:
        raise ValueError("separator must be one character")
    return sep

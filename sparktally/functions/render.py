"""Rendering of typed results into report text.

NULL is kept in typed results; only these helpers turn it into a label. The
null test comes before formatting: ``format_string('%.2f', NULL)`` is not
NULL but a piece of text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktally.functions.values import as_col


def two_decimals(col: Column | str) -> Column:
    """``%.2f`` text, rounding half up on the shortest decimal form.

    The value is rounded first with ``round`` (half up) so that the text is
    the same whatever digits the formatter would otherwise look at.
    """
    return F.format_string("%.2f", F.round(as_col(col), 2))


def two_decimals_or(col: Column | str, missing: str) -> Column:
    """Two-decimal text, or ``missing`` when the value is NULL."""
    c = as_col(col)
    return F.when(c.isNull(), F.lit(missing)).otherwise(two_decimals(c))


def pad_right(col: Column | str, width: int) -> Column:
    """``%-Ns``: left-aligned, padded with spaces to at least ``width``."""
    return F.format_string(f"%-{width}s", as_col(col))

"""Column expressions built only from ``pyspark.sql.functions``."""

from sparktally.functions.exact import exact_avg, exact_sum
from sparktally.functions.render import pad_right, two_decimals, two_decimals_or
from sparktally.functions.text import clean_text, java_trim, word_array
from sparktally.functions.values import (
    as_col,
    bucketize,
    in_synonyms,
    safe_double,
    safe_int,
    split_fields,
    strip_trailing,
)

__all__ = [
    "as_col",
    "bucketize",
    "clean_text",
    "exact_avg",
    "exact_sum",
    "in_synonyms",
    "java_trim",
    "pad_right",
    "safe_double",
    "safe_int",
    "split_fields",
    "strip_trailing",
    "two_decimals",
    "two_decimals_or",
    "word_array",
]

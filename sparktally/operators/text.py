"""Review text: validity filter, cleaning, tokenising, stop-word removal.

Tokens are produced by ``explode`` over a built-in split, so the whole chain
is one narrow, code-generated stage per partition; the only shuffle is the
one a later count needs. Stop words are removed with an anti-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktally.functions.text import text_words, word_array
from sparktally.operators.joins import anti_join


def valid_reviews(df: DataFrame, text: str = "review") -> DataFrame:
    """Rows whose text is neither NULL nor empty."""
    return df.where(F.col(text).isNotNull() & (F.col(text) != ""))


def tokenize(df: DataFrame, text: str = "review", word: str = "word", cleaned: bool = True) -> DataFrame:
    """One row per word of the text, in place of the text column; a text with
    no word gives no row. ``cleaned=False``: the text is raw, and is cleaned
    and split in one expression (``text_words``)."""
    words = word_array if cleaned else text_words
    cols = [F.explode(words(F.col(c))).alias(word) if c == text else F.col(c) for c in df.columns]
    return df.select(*cols)


def remove_stopwords(
    tokens: DataFrame,
    stopwords: DataFrame,
    word: str = "word",
    stopword: str = "stopword",
    long_list: bool = False,
) -> DataFrame:
    """Tokens whose word is not in the stop-word list (whole-token equality).

    An entry with a space can never equal a token, and repeated entries
    change nothing (an anti-join only asks whether a match exists), so the
    list needs no de-duplication. ``long_list``: the list grows with the
    corpus; a frequent word is then split over several tasks.
    """
    return anti_join(tokens, stopwords.select(stopword), word, stopword, hot_keys=long_list)


def clean_tokens(
    reviews: DataFrame,
    stopwords: DataFrame | None = None,
    text: str = "review",
    word: str = "word",
    lower_cols: Sequence[str] = ("category", "aspect", "sentiment"),
) -> DataFrame:
    """The token table: valid reviews, cleaned, one row per word, stop words
    removed. Columns are those of ``reviews`` with ``word`` in place of the
    text."""
    lowered = set(lower_cols)
    cols = [F.lower(F.col(c)).alias(c) if c in lowered else F.col(c) for c in reviews.columns]
    tokens = tokenize(valid_reviews(reviews, text).select(*cols), text, word, cleaned=False)
    return tokens if stopwords is None else remove_stopwords(tokens, stopwords, word)

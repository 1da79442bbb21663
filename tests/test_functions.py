"""Column functions against plain-Python statements of the same rules."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparktally.functions import (
    bucketize,
    clean_text,
    in_synonyms,
    java_trim,
    safe_double,
    safe_int,
    split_fields,
    two_decimals,
    two_decimals_or,
    word_array,
)
from sparktally.functions.text import text_words
from sparktally.operators.ratings import tag_parts

ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LOW = "".join(chr(i) for i in range(0x21))


def model_clean(s: str) -> str:
    """The cleaning steps taken literally, one after the other."""
    s = s.lower()
    s = re.sub(r"[-^]", " ", s)
    s = re.sub("[" + re.escape(ASCII_PUNCT) + "]", "", s)
    s = re.sub(r"[0-9]", "", s)
    s = re.sub(r"[ \t\n\x0b\f\r]+", " ", s)
    return s.strip(LOW)


ALPHABET = (
    "abcXYZ" + ASCII_PUNCT + "0123456789" + " \t\n\x0b\f\r" + "\x01\x1f\x7f" + "éÄßñ“”‘’–…"
)


def _corpus(n=1500, seed=7):
    rnd = random.Random(seed)
    out = [rnd.choice(["", " ", "-", "^", "a-b", "a,b", "x ^ y", " \t x \x01"])]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 30))))
    return out


def _apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_text_matches_literal_steps(spark):
    corpus = _corpus()
    got = _apply(spark, corpus, clean_text)
    assert got == [model_clean(s) for s in corpus]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=25), min_size=1, max_size=60))
def test_clean_text_property(spark, values):
    assert _apply(spark, values, clean_text) == [model_clean(s) for s in values]


def test_clean_text_examples(spark):
    got = _apply(spark, ["Tốt,đẹp", "Phòng-đẹp^quá", "“OK”  99 lần!!", "  ", "a\t\tb"], clean_text)
    assert got == ["tốtđẹp", "phòng đẹp quá", "“ok” lần", "", "a b"]


def test_text_words_equals_cleaned_split(spark):
    corpus = _corpus(seed=11)
    fast = _apply(spark, corpus, text_words)
    assert fast == _apply(spark, corpus, lambda c: word_array(clean_text(c)))
    assert fast == [[w for w in model_clean(s).split(" ") if w] for s in corpus]


def test_word_array_never_empty_words(spark):
    got = _apply(spark, ["", "a b", "a  b ", " a"], word_array)
    assert got == [[], ["a", "b"], ["a", "b"], ["a"]]


def test_java_trim_strips_controls(spark):
    assert _apply(spark, ["\tx ", "\x01x\x1f", " x "], java_trim) == ["x", "x", "x "]


def test_split_fields_drops_trailing_empty(spark):
    got = _apply(spark, ["a,b,,", "a,,b", ",a", "", "a, "], lambda c: split_fields(c, ","))
    assert got == [["a", "b"], ["a", "", "b"], ["", "a"], [""], ["a", " "]]


def test_tag_parts_like_java_split(spark):
    got = _apply(spark, ["Drama||", "a||b", "|||", " x | y ", "Drama| |"], lambda c: tag_parts(F.col(c) if isinstance(c, str) else c, "|"))
    assert got == [["Drama"], ["a", "", "b"], [], [" x ", " y "], ["Drama", " "]]


def test_safe_casts(spark):
    assert _apply(spark, ["4.5", "abc", "NaN", "4.0d", ""], safe_double)[:2] == [4.5, None]
    nan, d = _apply(spark, ["NaN", "4.0d"], safe_double)
    assert nan != nan and d == 4.0
    words = ["nan", "NAN", "inf", "INF", "INFINITY", "-inf", "+infinity", "infinity"]
    assert _apply(spark, words, safe_double) == [None] * len(words)
    inf = float("inf")
    assert _apply(spark, ["Infinity", "+Infinity", "-Infinity", "1e999", "0x1p3"], safe_double) == [inf, inf, -inf, inf, 8.0]
    assert _apply(spark, ["25", "25.7", "abc", "+7"], safe_int) == [25, None, None, 7]


def test_bucketize_right_closed(spark):
    df = spark.createDataFrame([(a,) for a in [None, 17, 18, 19, 35, 36, 50, 51]], "a int")
    got = [r[0] for r in df.select(bucketize("a", [18, 35, 50], ["0-18", "18-35", "35-50", "50+"])).collect()]
    assert got == [None, "0-18", "0-18", "18-35", "18-35", "35-50", "35-50", "50+"]


def test_bucketize_needs_matching_labels():
    with pytest.raises(ValueError):
        bucketize("a", [1, 2], ["x"])


def test_in_synonyms(spark):
    vals = ["M", "male", "MALE", "1", "F", "m ", "x", None]
    got = _apply(spark, vals, lambda c: in_synonyms(c, ["M", "Male"], ["1"]))
    assert got == [True, True, True, True, False, False, False, None]


def test_two_decimals_half_up_and_nulls(spark):
    got = _apply(spark, ["4.125", "4.25", "3.0", None], lambda c: two_decimals(c.cast("double")))
    assert got[:3] == ["4.13", "4.25", "3.00"]
    got = _apply(spark, [None, "2.5"], lambda c: two_decimals_or(c.cast("double"), "NA"))
    assert got == ["NA", "2.50"]

"""Text column expressions: Java-style trim, the review cleaner, word arrays.

All are compositions of built-in functions (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktally.functions.values import as_col

# The cleaning steps, in order: lower-case; hyphen and caret
# to a space; delete ASCII punctuation (\p{Punct}, the 32 characters
# !"#$%&'()*+,-./:;<=>?@[\]^_`{|}~); delete digits 0-9; collapse runs of
# whitespace ([ \t\n\x0B\f\r], Java's \s) to one space; trim.
#
# Every step but the collapse maps single characters, so after lower-casing
# they merge into one ``translate``: hyphen, caret and whitespace become a
# space, the other punctuation characters and the digits are deleted (a
# character of the first string without a counterpart in the second is
# removed). The ends are trimmed, and the words between spaces joined by one.
_ASCII_PUNCT = "".join(chr(i) for i in range(0x21, 0x7F) if not chr(i).isalnum())
_TO_SPACE = "-^\t\n\x0b\f\r"
_DELETED = "".join(ch for ch in _ASCII_PUNCT if ch not in "-^") + "0123456789"
TRANSLATE_FROM = _TO_SPACE + _DELETED
TRANSLATE_TO = " " * len(_TO_SPACE)

# Java's String.trim removes every character up to U+0020 at both ends;
# Spark's trim removes spaces only.
_JAVA_TRIM_CHARS = "".join(chr(i) for i in range(0x21))


def java_trim(col: Column | str) -> Column:
    """Strip characters <= U+0020 from both ends, like ``String.trim``."""
    return F.btrim(as_col(col), F.lit(_JAVA_TRIM_CHARS))


def clean_text(col: Column | str) -> Column:
    """Normalise review text before tokenising.

    lower-case -> hyphen and caret to a space -> delete ASCII punctuation
    (nothing left in its place) -> delete digits -> collapse whitespace runs
    to one space -> trim. The order matters: ``a-b`` becomes two words while
    ``a,b`` becomes one. Non-ASCII punctuation such as curly quotes survives.
    """
    return F.array_join(text_words(col), " ")


def _mapped(col: Column | str) -> Column:
    return F.translate(F.lower(as_col(col)), TRANSLATE_FROM, TRANSLATE_TO)


def word_array(cleaned: Column | str) -> Column:
    """Split cleaned text on spaces into an array with no empty words.

    ``split('', ' ')`` is ``['']``; a text that cleans to nothing therefore
    gives an empty array, and so no row once exploded.
    """
    return F.array_remove(F.split(as_col(cleaned), " "), "")


def text_words(col: Column | str) -> Column:
    """The words of raw text; joined by one space they are ``clean_text``.

    Runs of spaces need no collapsing when the text is split and empty
    words are dropped, so only the character map and the trim remain.
    """
    return F.array_remove(F.split(java_trim(_mapped(col)), " "), "")

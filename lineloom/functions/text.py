"""Predicates and splitting of script text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The words that mark a writing statement. The first three need
# the space after them.
WRITE_WORDS = ("create ", "merge ", "insert ", "spark.write")

# Line ends as Spark's line source sees them.
LINE_END = r"\r\n?|\n"

# Characters that end a word, as the inside of a regular-expression class.
# Asset names are the text after a last slash, so a slash can end a word too.
WORD_BREAKS = r"""\s"'`()\[\]{},;=<>|/\\"""


def mentions_any(text: Column, words) -> Column:
    """True if the lower-cased text holds at least one of the words."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w.lower())) for w in words])


def lines_of(text: Column) -> Column:
    """Array of lines; a final line end does not open another line."""
    upto = lambda n: F.substring(text, F.lit(1), F.length(text) - n)
    ends = lambda *marks: reduce(lambda a, b: a | b, [F.endswith(text, F.lit(m)) for m in marks])
    body = F.when(ends("\r\n"), upto(2)).when(ends("\n", "\r"), upto(1)).otherwise(text)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_END))


def words_of(text: Column) -> Column:
    """Words of a text, each with the one space that may follow it."""
    return F.regexp_extract_all(text, F.lit(f"[^{WORD_BREAKS}]+ ?"), F.lit(0))


def tokens_of(text: Column) -> Column:
    """Words of a text, each with the one word-breaking character that may follow it."""
    return F.regexp_extract_all(text, F.lit(f"[^{WORD_BREAKS}]+[{WORD_BREAKS}]?"), F.lit(0))


def pieces_of(word: Column, window: int) -> Column:
    """A word, or overlapping pieces of a long one (encoded data, minified code).

    Pieces are at most twice `window` long and overlap by `window`: whatever is
    at most `window` long and inside the word is inside one of the pieces. So
    nothing handled further gets long, and nothing of the text is left out.
    """
    cut = F.regexp_extract_all(word, F.lit(f"(?s)(?=(.{{1,{2 * window}}})).{{1,{window}}}"), F.lit(1))
    return F.when(F.octet_length(word) <= 2 * window, F.array(word)).otherwise(cut)


def grams_of(text: Column, size: int) -> Column:
    """All substrings of `size` characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))

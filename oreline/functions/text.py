"""Text columns: letters-and-digits normalisation, sentences, words, n-grams."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digit_like() -> str:
    """Digits outside the decimal class (superscripts, circled digits, ...).

    A character counts as a digit by its Unicode numeric type, which is wider
    than ``\\p{Nd}``.  Derived from the Unicode tables, as ranges.
    """
    points = [c for c in range(sys.maxunicode + 1)
              if chr(c).isdigit() and unicodedata.category(chr(c)) != "Nd"]
    ranges: list[list[int]] = []
    for c in points:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


# Runs of characters that are neither letter nor digit.  The first spelling is
# valid for Java and RE2; the second is the same set with the ranges behind a
# category test, which Java evaluates several times faster.
SEPARATORS = r"[^\p{L}\p{Nd}" + _digit_like() + "]+"
_JAVA_SEPARATOR = r"[^\p{L}\p{Nd}[\p{No}&&[" + _digit_like() + "]]]"
SENTENCE_END = r"\. "


def normalise(text: Column) -> Column:
    """Lower-cased letters and digits; every other character becomes a space."""
    return F.lower(F.regexp_replace(text, _JAVA_SEPARATOR, " "))


def sentences(text: Column) -> Column:
    """Array of sentences: the text cut at each literal full stop + space."""
    return F.split(text, SENTENCE_END)


def words(sentence: Column) -> Column:
    """Array of normalised words, cut before lower-casing: a letter whose lower
    case holds a combining mark does not end a word."""
    cut = F.lower(F.regexp_replace(sentence, _JAVA_SEPARATOR + "+", " "))
    return F.array_remove(F.split(cut, " "), "")


def word_windows(word_array: Column, width: int) -> Column:
    """One struct ``w1..wN`` per position: the word there and those after it.

    Words past the end are null.  Shifted slices zipped together stay inside
    generated code, unlike a lambda per position.
    """
    size = F.size(word_array)
    shifted = [word_array if k == 0 else
               F.slice(word_array, F.lit(k + 1), F.greatest(size - F.lit(k), F.lit(0)))
               for k in range(width)]
    return F.arrays_zip(*[s.alias(f"w{k + 1}") for k, s in enumerate(shifted)])


def window_gram(n: int) -> Column:
    """The n-gram starting at a window ``w1..wN``; null when it has fewer words."""
    parts = [F.col("w1")]
    for k in range(2, n + 1):
        parts += [F.lit(" "), F.col(f"w{k}")]
    return F.concat(*parts)

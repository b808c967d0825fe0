"""Error rates between an expected and an actual text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.text import tokens

# Distinct words of a pair become single characters from here on (supplementary planes, one
# million of them), so the built-in edit distance works on words.
FIRST_WORD_CHARACTER = 0x10000


def _rate(distance: Column, length: Column, other: Column) -> Column:
    empty = F.when(other == 0, F.lit(0.0)).otherwise(F.lit(1.0))
    return F.when(length == 0, empty).otherwise(distance / length)


def cer(expected: Column, actual: Column) -> Column:
    """Edit distance in characters over the expected length; may exceed 1."""
    left, right = F.coalesce(expected, F.lit("")), F.coalesce(actual, F.lit(""))
    distance = F.when(left == right, F.lit(0)).otherwise(F.levenshtein(left, right))
    return _rate(distance.cast("double"), F.length(left), F.length(right))


def _as_characters(words: Column, vocabulary: Column) -> Column:
    def character(word: Column) -> Column:
        code = F.array_position(vocabulary, word) + F.lit(FIRST_WORD_CHARACTER - 1)
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    return F.array_join(F.transform(words, character), "")


def wer(expected: Column, actual: Column) -> Column:
    """Edit distance in words over the expected number of words."""
    left, right = tokens(expected), tokens(actual)
    vocabulary = F.array_union(left, right)
    distance = F.levenshtein(_as_characters(left, vocabulary), _as_characters(right, vocabulary))
    distance = F.when(expected == actual, F.lit(0)).otherwise(distance)
    return _rate(distance.cast("double"), F.size(left), F.size(right))

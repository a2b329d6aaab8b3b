"""A dictionary of words: dense whole numbers, rarest words first."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pageloom.plans.numbering import numbered


def word_numbers(vocabulary: DataFrame) -> DataFrame:
    """``(word, df, word_id)`` from ``(word, df)``; numbers go by ``df``, then by word.

    Joins, groups and orders of words then work on eight bytes instead of strings, and
    a smaller number means an equally rare or rarer word.
    """
    return numbered(vocabulary.select("word", "df"), "df", "word", name="word_id")

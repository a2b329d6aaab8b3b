"""Token rows and the counts built on them.

A page table has ``page_id`` and ``text`` (``title`` and ``ns`` where a result
shows them), one row per ``page_id``.  Token rows are ``(page_id, pos, word)``,
positions from 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import ascii_words

Tokenizer = Callable[[Column], Column]


def tokens(pages: DataFrame, tokenizer: Tokenizer = ascii_words) -> DataFrame:
    """Every token with its position."""
    return pages.select("page_id", F.posexplode(tokenizer(F.col("text"))).alias("pos", "word"))


def counted_words(
    pages: DataFrame, tokenizer: Tokenizer = ascii_words, *keys: str
) -> DataFrame:
    """Per page the keys, ``n_words`` and ``counts``: its words, each with its number.

    A page is one row, so its words are counted where it is read: they are sorted, and a
    word's number is the way from its first place to the next word's.  Nothing is
    shuffled.  A page without text has an empty or null list.
    """
    sorted_words = pages.select(*keys, F.sort_array(tokenizer(F.col("text"))).alias("words"))
    size = F.size("words")
    first = lambda i: (i == 0) | (F.get("words", i) != F.get("words", i - 1))
    starts = F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), first))
    placed = sorted_words.withColumn("starts", starts)
    word = lambda i, j: F.struct(
        F.get("words", i).alias("word"),
        (F.coalesce(F.get("starts", j + 1), size) - i).cast("bigint").alias("n"),
    )
    return placed.select(
        *keys, size.cast("bigint").alias("n_words"), F.transform("starts", word).alias("counts")
    )


def count_rows(counted: DataFrame, *keys: str) -> DataFrame:
    """The ``counts`` of :func:`counted_words` as rows ``(*keys, word, n)``.

    Outer, for the reason given at :func:`explode_words`.
    """
    rows = counted.select(*keys, F.inline_outer("counts"))
    return rows.where(F.col("word").isNotNull())


def term_freq(pages: DataFrame, tokenizer: Tokenizer = ascii_words) -> DataFrame:
    """``(page_id, word, n)``, counted without a shuffle."""
    return count_rows(counted_words(pages, tokenizer, "page_id"), "page_id")


def explode_words(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per element of ``words``, with the key columns.

    The outer form is on purpose: for a plain explode of a column Spark adds a
    filter on the array's size, and moves it down to where the text would be
    split a second time.
    """
    exploded = rows.select(*keys, F.explode_outer("words").alias("word"))
    return exploded.where(F.col("word").isNotNull())


def sized_term_freq(pages: DataFrame, tokenizer: Tokenizer = ascii_words) -> DataFrame:
    """``(page_id, n_words, word, n)``: the counts with the length of their page."""
    return count_rows(counted_words(pages, tokenizer, "page_id"), "page_id", "n_words")


def doc_len(pages: DataFrame, tokenizer: Tokenizer = ascii_words) -> DataFrame:
    """``(page_id, n_words)`` for pages with at least one token.

    The length is the size of the token array, so no token row is made, and a page is
    one row, so nothing is shuffled.  Short lists instead of a filter: Spark would move
    that to where it splits the text again.
    """
    size = F.array(F.size(tokenizer(F.col("text"))).cast("bigint"))
    sizes = pages.select("page_id", F.explode_outer(F.filter(size, lambda n: n > 0)).alias("n_words"))
    return sizes.where(F.col("n_words").isNotNull())


def doc_freq(tf: DataFrame) -> DataFrame:
    """``(word, df)``: the number of pages that hold the word."""
    return tf.groupBy("word").agg(F.count("*").alias("df"))


def page_freq(pages: DataFrame, tokenizer: Tokenizer = ascii_words) -> DataFrame:
    """``(word, df)`` straight from the pages: one row per page and word, one shuffle."""
    words = pages.select(F.explode(F.array_distinct(tokenizer(F.col("text")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("df"))


def corpus_stats(pages: DataFrame, tokenizer: Tokenizer = ascii_words) -> DataFrame:
    """One row: pages (all of them), tokens and distinct words.

    Word counts are combined per task first, so that the distinct count never
    sees the repeats of a common word.
    """
    words = pages.select(F.explode(tokenizer(F.col("text"))).alias("word"))
    vocabulary = (
        words.groupBy("word")
        .agg(F.count("*").alias("n"))
        .agg(F.sum("n").alias("n_tokens"), F.count("*").alias("n_words"))
    )
    n_pages = pages.agg(F.count("*").alias("n")).scalar()
    return vocabulary.select(
        n_pages.alias("n_pages"),
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        "n_words",
    )


def line_chars(lines: DataFrame) -> DataFrame:
    """Characters of each line."""
    return lines.select("page_id", F.length("text").cast("bigint").alias("n_chars"))

"""Text expressions.

Each takes and returns a ``Column`` and is built from Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascii_words(text: Column) -> Column:
    """Runs of ASCII letters, lower-cased, in order and with repeats.

    Lowering comes after the regular expression: before it, a few non-ASCII
    letters would fold into ASCII ones.
    """
    letters = F.lower(F.regexp_replace(text, "[^a-zA-Z]+", " "))
    return F.array_remove(F.split(letters, " "), "")


def ws_words(text: Column) -> Column:
    """Whitespace-separated words, case and punctuation kept."""
    return F.array_remove(F.split(text, r"\s+"), "")


def space_words(line: Column) -> Column:
    """Pieces between single spaces; empty pieces are kept."""
    return F.split(line, " ")


def one_line(text: Column) -> Column:
    """Whitespace runs collapsed to one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def drop_non_ascii(text: Column) -> Column:
    """Only the ASCII characters of ``text``."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def is_alpha(word: Column) -> Column:
    return word.rlike("^[a-zA-Z]+$")


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` words joined by commas; empty if there are fewer."""
    last = F.size(words) - F.lit(n - 1)
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), ","))


def ngrams_compat(words: Column) -> Column:
    """The 5-gram windows of the older counting job.

    Only windows that end at 0-based positions 5 to size-2 are formed, and no
    comma stands between the last two words.
    """
    last_start = F.size(words) - F.lit(5)
    starts = F.when(last_start >= 2, F.sequence(F.lit(2), last_start)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        starts,
        lambda i: F.concat(
            F.array_join(F.slice(words, i, 4), ","), F.get(words, i + F.lit(3))
        ),
    )


def md5_bucket(word: Column, buckets: Column) -> Column:
    """A feature bucket that any SQL engine can recompute."""
    head = F.conv(F.substring(F.md5(word.cast("binary")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), buckets.cast("bigint"))


def first_space_split(key: Column) -> tuple[Column, Column]:
    """Split ``id title`` at its first space."""
    parts = F.split(key, " ", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))

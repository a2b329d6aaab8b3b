"""N-gram counts, and the most frequent n-grams without counting all of them.

:func:`most_frequent` is exact.  A sketch of fixed size (two rows of hashed sums, as in
count-min) bounds every n-gram's count from above.  The n-grams of the fullest buckets
are counted by name; the ``k``-th of them bounds the ``k``-th of all from below.  If a
bucket that was not counted reaches that bound, the n-grams whose two buckets both do are
counted once more.  What does not reach it can neither be nor tie with the ``k``-th.

So n-grams travel as hashed sums, and as strings only those few that can matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import ascii_words, ngrams, ngrams_compat
from pageloom.operators.terms import explode_words
from pageloom.plans.staging import stage

#: Buckets of one row of the sketch.
WIDTH = 1 << 16
#: Buckets counted first.
FULLEST = 64


def gram_rows(pages: DataFrame, n: int) -> DataFrame:
    """One row per n-gram occurrence."""
    words = pages.select(ascii_words(F.col("text")).alias("words"))
    return words.select(F.explode(ngrams(F.col("words"), n)).alias("gram"))


def gram_counts(pages: DataFrame, n: int) -> DataFrame:
    return gram_rows(pages, n).groupBy("gram").agg(F.count("*").alias("n"))


def gram_counts_compat(pages: DataFrame) -> DataFrame:
    """5-grams counted the way the older job prints them.

    There every window of a page appears once per token of that page.
    """
    words = pages.select(ascii_words(F.col("text")).alias("words"))
    grams = words.select(
        F.size("words").alias("times"), ngrams_compat(F.col("words")).alias("words")
    )
    rows = explode_words(grams, "times").withColumnRenamed("word", "gram")
    return rows.groupBy("gram").agg(F.sum("times").alias("n"))


def sum_counts(counted: DataFrame) -> DataFrame:
    """Add up ``(gram, n)`` rows."""
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def top_grams(counts: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent, shown from the rarest to the most frequent."""
    best = counts.orderBy(F.desc("n"), "gram").limit(k)
    return best.orderBy("n", F.desc("gram"))


def _hashed(pages: DataFrame, n: int) -> DataFrame:
    """Pages as ``words`` and ``hashes``, the hashes of the words."""
    words = pages.select(ascii_words(F.col("text")).alias("words"))
    return words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _starts(n: int) -> Column:
    last = F.size("hashes") - F.lit(n - 1)
    return F.when(last >= 1, F.sequence(F.lit(1), last))


def _buckets(gram: Column, width: int) -> tuple[Column, Column]:
    """A place in either row of the sketch, from one hash."""
    return F.pmod(gram, F.lit(width)), F.pmod(F.shiftright(gram, 32), F.lit(width)) + width


def sketch(pages: DataFrame, n: int, width: int = WIDTH) -> np.ndarray:
    """Two rows of sums; no n-gram occurs more often than either of its sums says."""
    gram = lambda i: F.xxhash64(F.slice("hashes", i, n))
    hashes = _hashed(pages, n).select(F.explode(F.transform(_starts(n), gram)).alias("gram"))
    return _sums(hashes.withColumn("times", F.lit(1)), width)


def _sums(hashes: DataFrame, width: int) -> np.ndarray:
    """The two rows of sums over hashed n-grams, ``(gram, times)``."""
    places = hashes.select(F.explode(F.array(*_buckets(F.col("gram"), width))).alias("place"), "times")
    out = np.zeros(2 * width, np.int64)
    for r in places.groupBy("place").agg(F.sum("times").alias("n")).toLocalIterator():  # at most 2 * width rows
        out[r["place"]] = r["n"]
    return out


def _is_open(open_buckets: np.ndarray):
    """Whether a place of the sketch is among the open ones."""
    flags = F.split(F.lit(",".join("1" if x else "" for x in open_buckets)), ",")
    return lambda place: F.get(flags, place.cast("int")) == "1"


def _counted(pages: DataFrame, n: int, open_buckets: np.ndarray, width: int) -> DataFrame:
    """``(gram, n)`` of the n-grams of which both buckets are open."""
    is_open = _is_open(open_buckets)

    def kept(i: Column) -> Column:
        first, second = _buckets(F.xxhash64(F.slice("hashes", i, n)), width)
        return is_open(first) & is_open(second)

    found = _hashed(pages, n).withColumn("at", F.filter(_starts(n), kept))
    grams = F.transform("at", lambda i: F.array_join(F.slice("words", i, n), ","))
    rows = found.select(F.explode(grams).alias("gram"))
    return rows.groupBy("gram").agg(F.count("*").alias("n"))


def most_frequent(pages: DataFrame, n: int, k: int = 5, width: int = WIDTH) -> DataFrame:
    """The rows of ``top_grams(gram_counts(pages, n), k)``."""
    return _top(sketch(pages, n, width), lambda open_: _counted(pages, n, open_, width), k, width)


def most_frequent_compat(pages: DataFrame, k: int = 5, width: int = WIDTH) -> DataFrame:
    """The rows of ``top_grams(gram_counts_compat(pages), k)``."""
    words = pages.select(ascii_words(F.col("text")).alias("words"))
    grams = words.select(F.size("words").alias("times"), ngrams_compat(F.col("words")).alias("grams"))
    hashed = F.transform("grams", lambda g: F.xxhash64(g))

    def counted(open_buckets: np.ndarray) -> DataFrame:
        is_open = _is_open(open_buckets)

        def kept(gram: Column) -> Column:
            first, second = _buckets(F.xxhash64(gram), width)
            return is_open(first) & is_open(second)

        rows = grams.select("times", F.explode(F.filter("grams", kept)).alias("gram"))
        return rows.groupBy("gram").agg(F.sum("times").alias("n"))

    return _top(_sums(grams.select("times", F.explode(hashed).alias("gram")), width), counted, k, width)


def _top(sums: np.ndarray, counted_of, k: int, width: int) -> DataFrame:
    """The ``k`` most frequent, by a sketch and a count of the n-grams of open buckets."""
    least = np.sort(sums[:width])[-min(FULLEST, width)]
    first = sums >= max(int(least), 1)
    first[width:] = True
    counted = stage(counted_of(first), "fullest-grams")
    best = counted.orderBy(F.desc("n")).limit(k).collect()
    bound = best[-1]["n"] if len(best) == k else 1
    needed = sums >= bound
    if (needed[:width] & ~first[:width]).any():
        counted = stage(counted_of(needed), "open-grams")
    return top_grams(counted, k)

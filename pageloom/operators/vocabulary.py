"""The number of distinct words of a corpus that grows, from mergeable sketches.

Each part of a corpus (a day, a file, a namespace) keeps one HyperLogLog sketch of its
words, a few kilobytes.  The words of any parts together are estimated from the union of
their sketches, so new parts need no recount of old ones.  :func:`pageloom.operators.terms.corpus_stats`
counts exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.functions.text import ascii_words
from pageloom.operators.terms import Tokenizer

#: Logarithm of a sketch's slots.
PRECISION = 14
#: Relative standard error, and how many of them an estimate may be off.
ERROR = 1.04 / math.sqrt(1 << PRECISION)
SIGMAS = 4


def _words(pages: DataFrame, tokenizer: Tokenizer, *keys: str) -> DataFrame:
    return pages.select(*keys, F.explode(tokenizer(F.col("text"))).alias("word"))


def sketches(
    pages: DataFrame, part: str, tokenizer: Tokenizer = ascii_words, precision: int = PRECISION
) -> DataFrame:
    """``(part, sketch)``: one sketch per part that has words, made before the shuffle."""
    sketch = F.hll_sketch_agg("word", F.lit(precision)).alias("sketch")
    return _words(pages, tokenizer, part).groupBy(part).agg(sketch)


def estimate(sketched: DataFrame, *by: str) -> DataFrame:
    """``(*by, estimate)``: distinct words of all sketches of a group together."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    return sketched.groupBy(*by).agg(union)


def exact(pages: DataFrame, part: str, tokenizer: Tokenizer = ascii_words) -> DataFrame:
    """``(part, n_words)``, with a row for all parts together, whose ``part`` is ``all``."""
    words = _words(pages, tokenizer, part).distinct()
    own = words.groupBy(part).agg(F.count("*").alias("n_words"))
    every = words.select("word").distinct().agg(F.count("*").alias("n_words"))
    return own.unionByName(every.select(F.lit("all").alias(part), "n_words"))


def compared(sketched: DataFrame, counted: DataFrame, part: str) -> DataFrame:
    """``(part, n_words, estimate, within)``: estimates beside exact numbers."""
    own = estimate(sketched, part)
    every = estimate(sketched).select(F.lit("all").alias(part), "estimate")
    off = F.abs(F.col("estimate") - F.col("n_words"))
    within = off <= F.greatest(F.lit(1.0), SIGMAS * ERROR * F.col("n_words"))
    return counted.join(own.unionByName(every), part).withColumn("within", within)

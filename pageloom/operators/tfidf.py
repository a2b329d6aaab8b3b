"""Term weights.

All forms start from the same two tables, staged once: the counts, a row per page, from
which ``(page_id, n_words, word, n)`` is read, and, where it is needed, the vocabulary
``(word, df)``.
The text is read and
tokenised a single time, and the join on the word sees the true size of the
vocabulary: it is broadcast if it is small, and otherwise shuffled against the
counts with both sides open to AQE's skew splitting, as the most common words
occur on nearly every page.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.text import ascii_words, md5_bucket, space_words, ws_words
from pageloom.operators import terms
from pageloom.operators.dictionary import word_numbers
from pageloom.plans.staging import stage


@dataclass(frozen=True)
class Counts:
    """Counts of one corpus; ``n_pages`` is a one-row expression.

    ``by_page`` holds the rows of ``tf`` as one row per page (``counts``), so that a join
    by page moves no row per word.
    """

    tf: DataFrame
    n_pages: Column
    by_page: DataFrame

    @cached_property
    def vocabulary(self) -> DataFrame:
        """``(word, df)``, staged when it is first asked for."""
        return stage(terms.doc_freq(self.tf), "vocabulary")

    @cached_property
    def dictionary(self) -> DataFrame:
        """``(word, df, word_id)``, staged when it is first asked for."""
        return word_numbers(terms.doc_freq(self.tf))


def count_corpus(
    pages: DataFrame,
    tokenizer: terms.Tokenizer = ascii_words,
    keep: Column | None = None,
    beside: DataFrame | None = None,
    also: tuple[str, ...] = (),
) -> Counts:
    """Stage the counts of the pages that pass ``keep``.

    ``n_pages`` counts every page, also those that ``keep`` turns away and
    those without a token.  ``beside`` has at most one row per ``page_id``, whose other
    columns are staged beside the counts in ``by_page``, as are the columns ``also`` of
    the pages.
    """
    kept = pages if keep is None else pages.where(keep)
    keys = ["page_id", *also]
    if beside is not None:  # the text is smaller than its counts, so it meets them first
        kept = kept.select(*keys, "text").join(beside, "page_id", "left")
        keys += [c for c in beside.columns if c != "page_id"]
    by_page = stage(terms.counted_words(kept, tokenizer, *keys), "tf")
    tf = terms.count_rows(by_page, "page_id", "n_words")
    return Counts(tf, pages.agg(F.count("*").alias("n")).scalar(), by_page)


def ratio(counts: Counts) -> DataFrame:
    """``n / length * ln(N / df)`` as ``(page_id, word, weight)``."""
    weight = F.col("n") / F.col("n_words") * F.ln(counts.n_pages / F.col("df"))
    return counts.tf.join(counts.vocabulary, "word").select(
        "page_id", "word", weight.alias("weight")
    )


def smoothed(counts: Counts) -> DataFrame:
    """``n * ln((N + 1) / (df + 1))`` as ``(page_id, word, weight)``."""
    return smoothed_of(counts.tf.join(counts.vocabulary, "word"), counts.n_pages, "word")


def smoothed_of(rows: DataFrame, n_pages: Column, word: str) -> DataFrame:
    return rows.select("page_id", F.col(word).alias("word"), smoothed_weight(n_pages).alias("weight"))


def smoothed_weight(n_pages: Column) -> Column:
    return F.col("n") * F.ln((n_pages + 1) / (F.col("df") + 1))


def smoothed_by_number(counts: Counts) -> DataFrame:
    """:func:`smoothed` with the numbers of ``counts.dictionary`` as ``word``."""
    return smoothed_of(counts.tf.join(counts.dictionary, "word"), counts.n_pages, "word_id")


def log2_words(text: Column) -> Column:
    """Lower-cased words of three or more characters between single spaces."""
    return F.filter(space_words(F.lower(text)), lambda w: F.length(w) >= 3)


def log2_ratio(counts: Counts) -> DataFrame:
    """``n / length * log2(N / df)``; count the corpus with :func:`log2_words`."""
    return _log2_of(counts.tf.join(counts.vocabulary, "word"), counts.n_pages, "word")


def log2_by_number(counts: Counts) -> DataFrame:
    """:func:`log2_ratio` with the numbers of ``counts.dictionary`` as ``word``."""
    return _log2_of(counts.tf.join(counts.dictionary, "word"), counts.n_pages, "word_id")


def _log2_of(rows: DataFrame, n_pages: Column, word: str) -> DataFrame:
    weight = F.col("n") / F.col("n_words") * F.log2(n_pages / F.col("df"))
    return rows.select("page_id", F.col(word).alias("word"), weight.alias("weight"))


def hashed(counts: Counts, buckets: Column | None = None) -> DataFrame:
    """Smoothed weights per feature bucket as ``(page_id, bucket, weight)``.

    Words of one bucket add up.  ``buckets`` defaults to the vocabulary size.
    """
    if buckets is None:
        buckets = counts.vocabulary.agg(F.count("*").alias("n")).scalar()
    by_bucket = (
        counts.tf.select("page_id", md5_bucket(F.col("word"), buckets).alias("bucket"), "n")
        .groupBy("page_id", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    tf = stage(by_bucket, "bucket-tf")
    df = stage(tf.groupBy("bucket").agg(F.count("*").alias("df")), "bucket-df")
    return tf.join(df, "bucket").select(
        "page_id", "bucket", smoothed_weight(counts.n_pages).alias("weight")
    )


def token_weights(
    pages: DataFrame, buckets: Column, tokenizer: terms.Tokenizer = ws_words
) -> DataFrame:
    """Every token position of a page with the smoothed weight of its bucket.

    A page's text is shuffled once, whole, in case its id comes with several rows.  Its
    tokens are then sorted by bucket in place, and a bucket's count is the length of its
    run; only the buckets' page counts are added up.  That table has at most ``buckets``
    rows, which the caller fixes, so it is broadcast and tokens are not shuffled.
    """
    texts = pages.where("page_id is not null").groupBy("page_id").agg(
        F.collect_list("text").alias("texts")
    )
    token = lambda w, i: F.struct(
        md5_bucket(w, buckets).alias("bucket"), i.alias("pos"), w.alias("word")
    )
    tokens = F.flatten(F.transform("texts", lambda t: F.transform(tokenizer(t), token)))
    placed = texts.select("page_id", F.sort_array(tokens).alias("tokens"))
    size = F.size("tokens")
    bucket = lambda i: F.get("tokens", i)["bucket"]
    first = lambda i: (i == 0) | (bucket(i) != bucket(i - 1))
    starts = F.when(size > 0, F.filter(F.sequence(F.lit(0), size - 1), first))
    held = lambda t: F.struct(t["pos"].alias("pos"), t["word"].alias("word"))
    run = lambda i, j: F.struct(
        bucket(i).alias("bucket"),
        F.transform(
            F.slice("tokens", i + 1, F.coalesce(F.get("starts", j + 1), size) - i), held
        ).alias("held"),
    )
    runs = placed.withColumn("starts", starts).select(
        "page_id", F.transform("starts", run).alias("runs")
    )
    located = stage(
        runs.select("page_id", F.inline_outer("runs")).where("bucket is not null"), "located"
    )
    df = stage(located.groupBy("bucket").agg(F.count("*").alias("df")), "bucket-df")
    n_pages = pages.agg(F.count("*").alias("n")).scalar()
    weighed = located.withColumn("n", F.size("held").cast("bigint")).join(F.broadcast(df), "bucket")
    return weighed.select("page_id", smoothed_weight(n_pages).alias("weight"), F.inline("held")).select(
        "page_id", "pos", "word", "weight"
    )


def weight_lists(weights: DataFrame, scale: int = 1_000_000) -> DataFrame:
    """One row per page: its words with their weights, in word order.

    A list is no longer than the text of its page.  Weights are shown as whole
    numbers of ``1/scale``.
    """
    units = F.round(F.col("weight") * scale).cast("bigint")
    item = F.concat_ws(":", "word", units.cast("string"))
    return weights.groupBy("page_id").agg(
        F.array_join(F.array_sort(F.collect_list(item)), " ").alias("weights"),
        F.count("*").alias("n_words"),
    )


def hashed_vectors(
    pages: DataFrame, tokenizer: terms.Tokenizer = ws_words, num_features: int = 1 << 20
) -> DataFrame:
    """TF-IDF as ML vectors: ``(page_id, tf, features)``.

    Term counts are staged, as fitting and transforming both read them.
    """
    no_words = F.array().cast("array<string>")
    words = pages.select(
        "page_id", F.coalesce(tokenizer(F.col("text")), no_words).alias("words")
    )
    hashing = HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features)
    tf = stage(hashing.transform(words).select("page_id", "tf"), "hashed-tf")
    model = IDF(inputCol="tf", outputCol="features").fit(tf)
    return model.transform(tf).select("page_id", "tf", "features")


def top_record(weights: DataFrame) -> DataFrame:
    """The single highest weight."""
    return weights.orderBy(F.desc(F.round("weight", 9)), "page_id", "word").limit(1)


def first_record(weights: DataFrame) -> DataFrame:
    """The first record by page, then word."""
    return weights.orderBy("page_id", "word").limit(1)


def top_terms_per_page(weights: DataFrame, k: int = 100) -> DataFrame:
    """Words whose weight reaches the ``k``-th highest of their page; ties stay."""
    order = Window.partitionBy("page_id").orderBy(F.desc(F.round("weight", 9)))
    return weights.withColumn("rank", F.rank().over(order)).where(F.col("rank") <= k)


def term_rows(pages: DataFrame, weights: DataFrame) -> DataFrame:
    """The document-term matrix over all words as ``(page_id, section, word, weight)``.

    A cell that is not listed is 0.
    """
    return weights.join(pages.select("page_id", "section"), "page_id").select(
        "page_id", "section", "word", "weight"
    )


def term_matrix(pages: DataFrame, weights: DataFrame, words: list[str]) -> DataFrame:
    """The matrix with one column per listed word, 0 where it is absent.

    ``pages`` gives ``page_id`` and ``section``.  The word list is the caller's,
    so the number of columns is fixed.
    """
    cells = (
        weights.where(F.col("word").isin(words))
        .groupBy("page_id")
        .agg(*[F.sum(F.when(F.col("word") == w, F.col("weight"))).alias(f"w_{w}") for w in words])
    )
    return pages.select("page_id", "section").join(cells, "page_id", "left").na.fill(0.0)

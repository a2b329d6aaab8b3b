"""Topics: what the words of a cluster are, and which pages belong to it.

Inputs are long rows: ``weights`` ``(page_id, word, weight)``, ``tf``
``(page_id, word, n)``, ``assignment`` ``(page_id, cluster)`` and ``titles``
``(page_id, title)``.  A centroid is kept as ``(cluster, word, weight)`` rows,
so it has no dense vector of vocabulary size anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.operators import tfidf
from pageloom.plans.staging import stage

TOPIC_WORDS = 100
SHOWN_WORDS = 5
SIZE_ABOVE = 1
SIZE_BELOW = 50
#: Sums that a task holds before it sends them, and sends at once.
HELD_ROWS, SENT_ROWS = 1 << 21, 1 << 15


def cluster_sizes(assignment: DataFrame) -> DataFrame:
    """``(cluster, n_pages)``, pages without a word included."""
    return assignment.groupBy("cluster").agg(F.count("*").alias("n_pages"))


def centroids(weights: DataFrame, assignment: DataFrame) -> DataFrame:
    """Mean weight of each word over all pages of its cluster."""
    sums = (
        weights.join(assignment, "page_id")
        .groupBy("cluster", "word")
        .agg(F.sum("weight").alias("total"))
    )
    sizes = stage(cluster_sizes(assignment), "cluster-sizes")
    return sums.join(sizes, "cluster").select(
        "cluster", "word", (F.col("total") / F.col("n_pages")).alias("weight")
    )


def clusters_of(assignment: DataFrame) -> DataFrame:
    """``(page_id, clusters)``, a row per page."""
    return assignment.groupBy("page_id").agg(F.sort_array(F.collect_list("cluster")).alias("clusters"))


def with_clusters(pages: DataFrame, cluster: Column) -> DataFrame:
    """``pages`` with the ``clusters`` of :func:`clusters_of`, where a page's row names one.

    Only pages whose id comes with several rows are looked up; no other text moves.
    """
    ids = pages.groupBy("page_id").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(cluster)).alias("all_clusters")
    )
    repeated = stage(ids.where("n > 1 and page_id is not null").drop("n"), "repeated-ids")
    own = F.when(F.col("page_id").isNotNull(), F.array_compact(F.array(cluster)))
    if repeated.isEmpty():
        return pages.withColumn("clusters", own)
    met = pages.join(repeated, "page_id", "left")
    return met.withColumn("clusters", F.coalesce("all_clusters", own)).drop("all_clusters")


def _sums_in_place(batches):
    """Per task and word: counts and pages, added up for the pages of the same clusters."""
    numbers, held, n_held = {}, [], 0

    def added(tables):
        table = pa.concat_tables(tables)
        columns = [("n", "sum"), ("pages", "sum")]
        return table.group_by(["clusters", "word"]).aggregate(columns).rename_columns(
            ["clusters", "word", "n", "pages"]
        )

    def sent(table):
        lists = pa.array([*numbers], pa.list_(kind))
        for batch in table.to_batches(max_chunksize=SENT_ROWS):
            yield pa.RecordBatch.from_arrays(
                [lists.take(batch["clusters"]), *(batch[c] for c in ("word", "n", "pages"))],
                names=["clusters", "word", "n", "pages"],
            )

    for batch in batches:
        kind = batch["clusters"].type.value_type
        counts = batch["counts"]
        sizes = np.nan_to_num(counts.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        own = [None if c is None else tuple(c) for c in batch["clusters"].to_pylist()]
        code = np.array([numbers.setdefault(c, len(numbers)) for c in own], np.int64)
        flat = counts.flatten()
        rows = pa.table({
            "clusters": np.repeat(code, sizes), "word": flat.field("word"), "n": flat.field("n"),
            "pages": np.ones(len(flat), np.int64),
        })
        held.append(added([rows]))
        n_held += len(held[-1])
        if n_held > HELD_ROWS:
            held = [added(held)]
            n_held = len(held[0])
            if n_held > HELD_ROWS // 2:
                yield from sent(held.pop())
                n_held = 0
    if held:
        yield from sent(added(held))


def smoothed_centroids(counts: tfidf.Counts, assignment: DataFrame) -> DataFrame:
    """:func:`centroids` of the smoothed weights of ``counts``.

    A word's factor is the same on all pages, so its counts are added up first for the
    pages of the same clusters, in every task, and the sums that remain give its page
    count, too.  No row per page and word is shuffled; if the counts were staged beside the
    clusters, nothing else than the sums is, once, by word.
    """
    by_page = counts.by_page
    if "clusters" not in by_page.columns:
        by_page = by_page.join(clusters_of(assignment), "page_id", "left")
    kind = by_page.schema["clusters"].dataType.simpleString()
    sums = (
        by_page.select("clusters", "counts")
        .mapInArrow(_sums_in_place, f"clusters {kind}, word string, n long, pages long")
        .repartition("word")
        .groupBy("clusters", "word")
        .agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"))
        .withColumn("df", F.sum("pages").over(Window.partitionBy("word")))
        .select("word", "n", "df", F.explode("clusters").alias("cluster"))
        .groupBy("cluster", "word")
        .agg(F.sum("n").alias("n"), F.max("df").alias("df"))
    )
    sizes = stage(cluster_sizes(assignment), "cluster-sizes")
    total = tfidf.smoothed_weight(counts.n_pages)
    return sums.join(sizes, "cluster").select(
        "cluster", "word", (total / F.col("n_pages")).alias("weight")
    )


def top_terms(centroid_rows: DataFrame, k: int = TOPIC_WORDS) -> DataFrame:
    """The ``k`` heaviest words per cluster, ties by word: ``(cluster, word, rank)``.

    Spark limits each task to ``k`` rows per cluster before it shuffles.
    """
    order = Window.partitionBy("cluster").orderBy(F.desc(F.round("weight", 9)), "word")
    return (
        centroid_rows.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("cluster", "word", "rank")
    )


def frequent_terms(
    tf: DataFrame, assignment: DataFrame, at_least: int = 50, cluster=None
) -> DataFrame:
    """Words with a total count of ``at_least`` in a cluster (or in each one)."""
    return (
        tf.join(members(assignment, cluster), "page_id")
        .groupBy("cluster", "word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= at_least)
    )


def members(assignment: DataFrame, cluster=None) -> DataFrame:
    """``(cluster, page_id)`` of one cluster, or of each."""
    rows = assignment.select("cluster", "page_id")
    return rows if cluster is None else rows.where(F.col("cluster") == cluster)


def overlap(tf: DataFrame, topic_words: DataFrame) -> DataFrame:
    """``(page_id, cluster, n_tokens)``: tokens of the page that are topic words.

    Repeats count.  A page without any topic word has no row.
    """
    return (
        tf.join(topic_words.select("cluster", "word"), "word")
        .groupBy("page_id", "cluster")
        .agg(F.sum("n").alias("n_tokens"))
    )


def page_topics(overlaps: DataFrame, min_overlap: int) -> DataFrame:
    """Every cluster a page reaches ``min_overlap`` (>= 1) tokens in."""
    if min_overlap < 1:
        raise ValueError("min_overlap must be at least 1")
    return overlaps.where(F.col("n_tokens") >= min_overlap).select("page_id", "cluster")


def size_band(
    memberships: DataFrame, above: int = SIZE_ABOVE, below: int | None = SIZE_BELOW
) -> DataFrame:
    """Clusters with more than ``above`` and fewer than ``below`` pages (if given)."""
    sizes = memberships.groupBy("cluster").agg(F.count("*").alias("n_pages"))
    kept = sizes.where(F.col("n_pages") > above)
    return kept if below is None else kept.where(F.col("n_pages") < below)


def titles_of_topics(
    memberships: DataFrame, kept: DataFrame, titles: DataFrame
) -> DataFrame:
    """``(cluster, title)`` of the kept clusters."""
    return (
        memberships.join(kept.select("cluster"), "cluster", "left_semi")
        .join(titles, "page_id")
        .select("cluster", "title")
    )


def title_lists(titled: DataFrame) -> DataFrame:
    """``(cluster, n_titles, titles)``; the size band bounds each list."""
    return titled.groupBy("cluster").agg(
        F.count("*").alias("n_titles"),
        F.array_join(F.array_sort(F.collect_list("title")), " | ").alias("titles"),
    )


def catalog(topic_words: DataFrame, titled: DataFrame, shown: int = SHOWN_WORDS) -> DataFrame:
    """Per kept cluster its first words and its titles."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "word")))
    words = (
        topic_words.where(F.col("rank") <= shown)
        .groupBy("cluster")
        .agg(F.array_join(F.transform(ranked, lambda s: s["word"]), ",").alias("words"))
    )
    return words.join(title_lists(titled), "cluster")


def catalog_counts(topic_words: DataFrame, titled: DataFrame, shown: int = SHOWN_WORDS) -> DataFrame:
    """Per kept cluster its first words and the number of its titles.

    For bands without a small upper end; the titles themselves stay rows.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rank", "word")))
    words = (
        topic_words.where(F.col("rank") <= shown)
        .groupBy("cluster")
        .agg(F.array_join(F.transform(ranked, lambda s: s["word"]), ",").alias("words"))
    )
    return words.join(titled.groupBy("cluster").agg(F.count("*").alias("n_titles")), "cluster")


def topic_title_pairs(topic_words: DataFrame, titled: DataFrame) -> DataFrame:
    """The search table: every topic word with every title of its cluster.

    One side is bounded per cluster by the number of topic words, so the rows are at
    most that many times the memberships.
    """
    return topic_words.join(titled, "cluster").select(F.col("word").alias("topic"), "title")


@dataclass(frozen=True)
class TopicModel:
    """Staged results of one topic run."""

    topic_words: DataFrame
    overlaps: DataFrame
    memberships: DataFrame
    kept: DataFrame
    titled: DataFrame

    def catalog(self) -> DataFrame:
        return catalog(self.topic_words, self.titled)

    def counted(self) -> DataFrame:
        return catalog_counts(self.topic_words, self.titled)

    def pairs(self) -> DataFrame:
        return topic_title_pairs(self.topic_words, self.titled)


def build_topics(
    tf: DataFrame,
    weights: DataFrame,
    assignment: DataFrame,
    titles: DataFrame,
    min_overlap: int,
    words: int = TOPIC_WORDS,
    above: int = SIZE_ABOVE,
    below: int | None = SIZE_BELOW,
) -> TopicModel:
    """Centroids, topic words, memberships, kept clusters and their titles."""
    centres = centroids(weights, assignment)
    return topics_of_centroids(tf, centres, titles, min_overlap, words, above, below)


def topics_of_centroids(
    tf: DataFrame,
    centres: DataFrame,
    titles: DataFrame,
    min_overlap: int,
    words: int = TOPIC_WORDS,
    above: int = SIZE_ABOVE,
    below: int | None = SIZE_BELOW,
) -> TopicModel:
    """:func:`build_topics` from centroids that are there already."""
    topic_words = stage(top_terms(centres, words), "topic-words")
    overlaps = overlap(tf, topic_words)
    memberships = stage(page_topics(overlaps, min_overlap), "memberships")
    kept = stage(size_band(memberships, above, below), "kept-topics")
    titled = stage(titles_of_topics(memberships, kept, titles), "titled")
    return TopicModel(topic_words, overlaps, memberships, kept, titled)

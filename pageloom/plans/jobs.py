"""The end-to-end jobs, each from input files to written results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import fixtures
from pageloom.functions.text import ws_words
from pageloom.operators import (
    ngrams,
    page_graph,
    pagerank,
    search,
    similarity,
    terms,
    tfidf,
    topics,
)
from pageloom.operators.sparse_kmeans import sparse_kmeans
from pageloom.plans.staging import scratch_path, stage
from pageloom.sources import lines as ln
from pageloom.sources import wiki_xml as wx
from pageloom.streaming import jobs as stream

def _is_article() -> Column:
    return F.col("ns") == "0"


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages from files with one ``<page>`` per line."""
    return wx.parse_page_lines(ln.read_lines(spark, path))


def gram_job(spark: SparkSession, path: str, out: str, n: int = 5, k: int = 5) -> DataFrame:
    """Wiki chunks -> the ``k`` most frequent n-grams, as tab lines."""
    pages = stage(wx.revision_texts(wx.read_page_chunks(spark, path)), "revisions")
    best = stage(ngrams.most_frequent(pages, n, k), "top")
    ln.write_fields(best.orderBy("n", F.desc("gram")).coalesce(1), out)
    return best


def tfidf_job(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Wiki pages -> the word and page with the highest weight."""
    pages = wiki_pages(spark, path)
    best = tfidf.top_record(tfidf.ratio(tfidf.count_corpus(pages, keep=_is_article())))
    named = stage(best.join(pages.select("page_id", "title"), "page_id"), "top-record")
    ln.write_fields(named.select("page_id", "title", "word", "weight"), out)
    return named


def component_job(
    spark: SparkSession, path: str, threshold: float, out: str, metric: str = "euclid"
) -> DataFrame:
    """Wiki pages -> components of similar pages with sizes and titles."""
    pages = wiki_pages(spark, path)
    vectors = similarity.build_vectors(pages, keep=_is_article())
    by_leaders = metric == "euclid"
    labels = stage(page_graph.page_components(vectors, threshold, metric, by_leaders), "labels")
    members = page_graph.component_members(labels)
    report = members.join(pages.select("page_id", "title"), "page_id")
    report.write.parquet(out)
    return spark.read.schema(report.schema).parquet(out)


def pagerank_job(
    spark: SparkSession,
    path: str,
    links_path: str,
    rounds: int,
    out: str,
    threshold: float = 0.3,
    either: bool = False,
) -> DataFrame:
    """Wiki pages and links -> the five highest ranked representatives.

    Representatives are the shortest pages of the components of similar pages.
    """
    pages = wiki_pages(spark, path)
    vectors = similarity.build_vectors(pages, keep=_is_article())
    labels = page_graph.page_components(vectors, threshold, by_leaders=True)
    chosen = page_graph.shortest_pages(labels, vectors.lengths).select(
        F.col("page_id").cast("string").alias("page")
    )
    links = ln.parse_edge_lines(ln.read_lines(spark, links_path))
    ranked = pagerank.ranks(pagerank.links_between(links, chosen, either), rounds)
    titles = pages.select(F.col("page_id").cast("string").alias("page"), "title")
    best = stage(pagerank.top_pages(ranked, titles), "best")
    ln.write_fields(best.orderBy("rank", F.desc("page")).coalesce(1), out)
    return best


def tab_pages(spark: SparkSession, path: str) -> DataFrame:
    return ln.parse_tab_corpus(ln.read_lines(spark, path))


def weights_job(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Tab corpus -> every page's words with their smoothed weights."""
    pages = tab_pages(spark, path)
    weights = tfidf.smoothed(tfidf.count_corpus(pages, ws_words))
    named = weights.join(pages.select("page_id", "title"), "page_id")
    named.write.parquet(out)
    return spark.read.schema(named.schema).parquet(out)


def kmeans_assignment(counts: tfidf.Counts, pages: DataFrame, k: int) -> DataFrame:
    """Clusters of all pages by the smoothed TF-IDF of their words."""
    return sparse_kmeans(tfidf.smoothed_by_number(counts), k, pages=pages)[0]


def topics_of(pages: DataFrame, min_overlap: int, k: int) -> topics.TopicModel:
    """TF-IDF, k-means, topic words, memberships and the size band."""
    counts = tfidf.count_corpus(pages, ws_words)
    return topics.topics_of_centroids(
        counts.tf,
        topics.smoothed_centroids(counts, kmeans_assignment(counts, pages, k)),
        pages.select("page_id", "title"),
        min_overlap,
    )


def topic_job(
    spark: SparkSession,
    path: str,
    catalog_out: str,
    pairs_out: str,
    min_overlap: int,
    k: int = 50,
) -> topics.TopicModel:
    """Tab corpus -> the topic catalogue, and the ``topic,title`` search table."""
    model = topics_of(tab_pages(spark, path), min_overlap, k)
    model.catalog().write.parquet(catalog_out)
    model.pairs().write.csv(pairs_out)
    return model


def topic_stream_job(
    spark: SparkSession,
    path: str,
    out: str,
    min_overlap: int,
    checkpoint: str,
    k: int = 50,
    interval: str | None = stream.TOPIC_INTERVAL,
):
    """Tab corpus files as they arrive -> a catalogue per batch."""
    arriving = ln.parse_tab_corpus(stream.line_stream(spark, path))
    work = stream.topic_batches(
        out,
        lambda batch: kmeans_assignment(tfidf.count_corpus(batch, ws_words), batch, k),
        min_overlap,
        show=interval is not None,
    )
    return stream.start(arriving, work, checkpoint, interval)


def search_job(
    spark: SparkSession, table_path: str, out: str, topic: str | None = None
) -> DataFrame:
    """The search table as a view: all of it labelled, or one topic's titles, as CSV."""
    search.register(ln.read_topic_table(spark, table_path))
    found = search.labelled(spark) if topic is None else search.titles_for(spark, topic)
    ln.write_csv(found, out)
    return spark.read.schema(found.schema).csv(out, header=True)


def lookup_stream_job(
    spark: SparkSession,
    table_path: str,
    lines_path: str,
    out: str,
    checkpoint: str,
    interval: str | None = stream.LOOKUP_INTERVAL,
):
    """Topics that arrive as lines -> their titles, from a table stored for look-ups."""
    path = scratch_path(spark, "search-table")
    search.store(ln.read_topic_table(spark, table_path), path)
    table = search.stored(spark, path)
    return stream.lookup(stream.line_stream(spark, lines_path), table, out, checkpoint, interval)


def matrix_job(spark: SparkSession, path: str, out: str, k: int = 50) -> DataFrame:
    """One document per line -> the top words of each document, as CSV.

    Documents are clustered at unit length; the cluster stands beside the words.
    """
    # staged, so that a line keeps its number in every later step
    numbered = ln.read_lines(spark, path).select(
        F.monotonically_increasing_id().alias("page_id"), F.col("value").alias("text")
    )
    pages = stage(numbered, "line-pages")
    counts = tfidf.count_corpus(pages, tfidf.log2_words)
    clusters, _ = sparse_kmeans(tfidf.log2_by_number(counts), k, unit_length=True, pages=pages)
    top = tfidf.top_terms_per_page(tfidf.log2_ratio(counts)).join(clusters, "page_id")
    ln.write_csv(top, out)
    return spark.read.schema(top.schema).csv(out, header=True)


def topic_search_demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> k-means topics -> search table -> titles per topic, by SQL."""
    pages = fixtures.pages(spark, sf_dir)
    model = topics_of(pages, min_overlap=20, k=8)
    search.register(stage(model.pairs(), "pairs"))
    return spark.sql(
        "SELECT topic, count(DISTINCT title) AS n_titles, min(title) AS first_title "
        f"FROM {search.VIEW} GROUP BY topic ORDER BY n_titles DESC, topic LIMIT 20"
    )

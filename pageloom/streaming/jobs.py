"""Micro-batch forms.

Every batch is worked on by itself; nothing is carried from one to the next.  Results
are written by way of :class:`~pageloom.streaming.batches.BatchLog`, so readers see whole
batches only, and restarts add nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from pageloom.functions.text import ws_words
from pageloom.operators import search, tfidf, topics
from pageloom.plans.staging import scratch_path, stage, unstage
from pageloom.streaming.batches import BatchLog

#: Seconds between batches of the topic job and of the lookup.
TOPIC_INTERVAL = "15 seconds"
LOOKUP_INTERVAL = "3 seconds"

#: Rows that a lookup finds.
FOUND = StructType([StructField("topic", StringType()), StructField("title", StringType())])

Assign = Callable[[DataFrame], DataFrame]


def parquet_stream(
    spark: SparkSession, schema: StructType, path: str, files_per_batch: int | None
) -> DataFrame:
    """Files that arrive under ``path`` (a folder or a glob).

    What is in one batch decides the result: each batch has its own document counts.
    Without ``files_per_batch`` a batch is all that has arrived since the last one.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def line_stream(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the text files that arrive under ``path``."""
    return spark.readStream.text(path)


def start(
    stream: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Run ``work`` on each batch; without an interval, on what is there now."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def tfidf_batches(out: str) -> Callable[[DataFrame, int], None]:
    """Smoothed TF-IDF of each batch, by that batch's own counts: table ``weights``."""

    def work(batch: DataFrame, batch_id: int) -> None:
        log = BatchLog(batch.sparkSession, out)
        if log.committed(batch_id):
            return
        held = stage(batch.select("page_id", "text"), "batch")
        log.commit(batch_id, weights=tfidf.smoothed(tfidf.count_corpus(held, ws_words)))
        unstage(held)

    return work


def topic_batches(
    out: str,
    assign: Assign,
    min_overlap: int,
    show: bool = False,
    below: int | None = topics.SIZE_BELOW,
    cluster: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The topic job on each batch: tables ``catalog`` and ``pairs``, which appear together.

    The batch is read once.  Without ``below`` topics may be of any size, and the
    catalogue counts their titles instead of listing them.  If ``assign`` takes a page's
    cluster from its own row, ``cluster`` may name that column, and no text is shuffled.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        log = BatchLog(batch.sparkSession, out)
        if log.committed(batch_id):
            return
        held = stage(batch, "batch")
        assignment = assign(held)
        if cluster is None:
            counts = tfidf.count_corpus(held, ws_words, beside=topics.clusters_of(assignment))
        else:
            named = topics.with_clusters(held, F.col(cluster))
            counts = tfidf.count_corpus(named, ws_words, also=("clusters",))
        model = topics.topics_of_centroids(
            counts.tf,
            topics.smoothed_centroids(counts, assignment),
            held.select("page_id", "title"),
            min_overlap,
            below=below,
        )
        found = model.catalog() if below else model.counted()
        log.commit(batch_id, catalog=found, pairs=model.pairs())
        if show:
            found.orderBy("cluster").show(10, truncate=80)
        unstage(held)

    return work


def lookup(
    lines: DataFrame,
    table: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    buckets: int = search.BUCKETS,
) -> StreamingQuery:
    """Titles for every topic word that arrives as a line: table ``found``.

    ``table`` was written by :func:`pageloom.operators.search.store`; a batch reads the
    folders of the topics asked for in it.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        log = BatchLog(batch.sparkSession, out)
        if log.committed(batch_id):
            return
        asked = stage(batch.select(F.trim("value").alias("topic")), "asked")
        log.commit(batch_id, found=search.stored_matches(asked, table, buckets))
        unstage(asked)

    return start(lines, work, checkpoint, interval)


def read_batches(
    spark: SparkSession, out: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """The committed rows of one table of a stream's output, with ``batch_id``."""
    return BatchLog(spark, out).read(name, schema)


def run_now(
    spark: SparkSession, stream: DataFrame, work_for: Callable[[str], Callable], name: str
) -> str:
    """Work off what has arrived; returns the output folder."""
    out = scratch_path(spark, name)
    start(stream, work_for(out), scratch_path(spark, f"{name}-checkpoint")).awaitTermination()
    return out

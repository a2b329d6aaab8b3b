"""The topic table as a SQL view or a stored table, and searches in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIEW = "clust"


def register(pairs: DataFrame, view: str = VIEW) -> None:
    """Make ``(topic, title)`` rows known to SQL."""
    pairs.createOrReplaceTempView(view)


def all_titles(spark: SparkSession, view: str = VIEW) -> DataFrame:
    return spark.sql(f"SELECT title FROM {view}")


def titles_for(spark: SparkSession, topic: str, view: str = VIEW) -> DataFrame:
    """Titles under one topic word; the word is a bound parameter."""
    return spark.sql(
        f"SELECT DISTINCT topic, title FROM {view} WHERE topic = :topic", args={"topic": topic}
    )


def labelled(spark: SparkSession, view: str = VIEW) -> DataFrame:
    """Rows with the topic shown as ``Topic: <word>``."""
    return spark.sql(f"SELECT concat('Topic: ', topic) AS label, title FROM {view}")


#: Folders of a stored table; a topic is in one of them.
BUCKETS = 64
#: Rows that one task sorts when a table is stored; they compress too well for their
#: shuffled bytes to tell.
ROWS_PER_RANGE = 1 << 21


def bucket_of(topic: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(topic), F.lit(buckets)).cast("int")


def store(pairs: DataFrame, path: str, buckets: int = BUCKETS, files: int | None = None) -> None:
    """Write ``(topic, title)`` rows so that a search reads little of them.

    A topic's rows are in one folder, by its hash; files hold ranges of topic and title
    in order, with Parquet's page indexes and a Bloom filter of the topics.  Ranges are
    cut by rows, so a topic that holds a third of them spans several files; without
    ``files`` there are as many as keep what a task sorts bounded.
    """
    if files is None:
        files = -(-pairs.count() // ROWS_PER_RANGE) or 1
    rows = pairs.select("topic", "title").withColumn("bucket", bucket_of(F.col("topic"), buckets))
    order = ("bucket", "topic", "title")
    ranged = rows.repartitionByRange(files, *order)
    (
        ranged.sortWithinPartitions(*order)
        .write.partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#topic", "true")
        .option("parquet.page.size", str(64 * 1024))
        .parquet(path)
    )


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`store`: ``(topic, title, bucket)``."""
    return spark.read.schema("topic string, title string, bucket int").parquet(path)


def stored_titles(table: DataFrame, topic: str, buckets: int = BUCKETS) -> DataFrame:
    """Titles under one topic word; one folder and the pages that may hold the word are read."""
    here = (F.col("bucket") == bucket_of(F.lit(topic), buckets)) & (F.col("topic") == topic)
    return table.where(here).select("topic", "title").distinct()


def stored_matches(asked: DataFrame, table: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(topic, title)`` for every row of ``asked`` (``topic``), which is read twice.

    The folders of the asked topics are looked up first (at most ``buckets`` numbers),
    and the others are not even listed for the join.
    """
    named = asked.select("topic", bucket_of(F.col("topic"), buckets).alias("bucket"))
    needed = [r["bucket"] for r in named.select("bucket").distinct().collect()]
    some = table.where(F.col("bucket").isin([b for b in needed if b is not None]))
    # a sort-merge join holds one key's rows of its right side, so that is the asked topics
    return some.join(named, ["bucket", "topic"]).select("topic", "title")

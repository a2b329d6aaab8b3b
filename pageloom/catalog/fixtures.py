"""The test tables, seen as the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_pages(documents: DataFrame) -> DataFrame:
    """Documents as wiki pages; English ones stand for namespace 0."""
    return documents.select(
        F.col("doc_id").alias("page_id"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("title"),
        F.when(F.col("lang") == "en", "0").otherwise("4").alias("ns"),
        F.col("source").alias("section"),
        "n_chars",
        "text",
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_pages(table(spark, sf_dir, "documents"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_pages(table(spark, sf_dir, "documents")).select("page_id", "title")


def assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters that need no random start: the source of each document."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.col("source").alias("cluster")
    )


def part_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between parts: a line of an order links to the next one by number."""
    lines = table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber")
    here = lines.select("l_orderkey", number.alias("line"), F.col("l_partkey").alias("src"))
    # numbers repeat within an order, so this is a join and not the next row of a window
    following = lines.select(
        "l_orderkey", (number - 1).alias("line"), F.col("l_partkey").alias("dst")
    )
    return here.join(following, ["l_orderkey", "line"]).select("src", "dst")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between documents by a rule on their ids: each links to three others."""
    documents = table(spark, sf_dir, "documents")
    n = documents.agg((F.max("doc_id") + 1).alias("n")).scalar()
    src = F.col("doc_id")
    targets = F.array((src + 1) % n, (src * 3 + 1) % n, (src * 7 + 5) % n)
    return documents.select(src.alias("src"), F.explode(targets).alias("dst"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features")
    )

"""Readers for line-based inputs and writers for line-based outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.text import first_space_split

TOPIC_TABLE = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
    ]
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in the column ``value``."""
    return spark.read.text(path)


def parse_tab_corpus(lines: DataFrame) -> DataFrame:
    """``id title<TAB>text`` lines.

    A line without a tab has a null text; fields after the second are ignored.
    """
    fields = F.split("value", "\t")
    key, title = first_space_split(F.get(fields, F.lit(0)))
    return lines.select(
        key.try_cast("bigint").alias("page_id"),
        title.alias("title"),
        F.get(fields, F.lit(1)).alias("text"),
    )


def read_topic_table(spark: SparkSession, path: str) -> DataFrame:
    """``topic,title`` lines with the fixed, nullable schema."""
    return spark.read.schema(TOPIC_TABLE).csv(path)


def parse_edge_lines(lines: DataFrame) -> DataFrame:
    """The first two whitespace-separated fields of each line, each link once."""
    fields = F.split("value", r"\s+")
    return (
        lines.select(
            F.get(fields, F.lit(0)).alias("src"), F.get(fields, F.lit(1)).alias("dst")
        )
        .where("src is not null and dst is not null")
        .distinct()
    )


def parse_count_lines(lines: DataFrame) -> DataFrame:
    """``key<TAB>count`` lines; header lines and bad counts are dropped.

    Header lines are those that begin with ``id`` or ``title``, then a space,
    and hold no tab.
    """
    value = F.trim("value")
    parts = F.split(value, "\t", 2)
    header = value.rlike("^(id|title) [^\t]*$")
    return (
        lines.where(~header)
        .select(
            F.get(parts, F.lit(0)).alias("gram"),
            F.trim(F.get(parts, F.lit(1))).try_cast("bigint").alias("n"),
        )
        .where("n is not null")
    )


def write_fields(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Every row as one text line, its columns joined by ``sep``."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *cols).alias("value")).write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)

"""Wiki pages in XML: one page per line, or chunks that hold many pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.text import drop_non_ascii, one_line

PAGE_SCHEMA = (
    "title string, ns string, id bigint, "
    "revision array<struct<id: bigint, contributor: struct<id: bigint>, text: string>>"
)


def _flatten(pages: DataFrame) -> DataFrame:
    """The page with its last revision, and all revisions as a list."""
    last = F.try_element_at("revision", F.lit(-1))
    return pages.select(
        F.col("id").alias("page_id"),
        "title",
        "ns",
        last["text"].alias("text"),
        last["id"].alias("revision_id"),
        last["contributor"]["id"].alias("contributor_id"),
        F.transform(
            "revision",
            lambda r: F.struct(
                r["id"].alias("id"), r["contributor"]["id"].alias("contributor_id"), r["text"].alias("text")
            ),
        ).alias("revisions"),
    )


def parse_page_lines(lines: DataFrame) -> DataFrame:
    """One ``<page>`` element per line; a malformed line gives null fields."""
    page = F.from_xml("value", PAGE_SCHEMA, {"rowTag": "page"})
    return _flatten(lines.select(page.alias("page")).select("page.*"))


def read_page_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Files with any number of ``<page>`` elements and no single root.

    A record ends at ``</page>``, so pages may span lines, and a large file is
    still read in many splits.
    """
    records = spark.read.option("lineSep", "</page>").text(path)
    start = F.regexp_extract("value", r"(?s)<page[\s>].*", 0)
    return parse_page_lines(
        records.select(start.alias("start"))
        .where("start <> ''")
        .select(F.concat("start", F.lit("</page>")).alias("value"))
    )


def render_pages(pages: DataFrame) -> DataFrame:
    """Pages as ``<page>`` elements, one per line, in the column ``value``.

    ``older``, if there is such a column, lists earlier revisions as
    ``(id, contributor_id, text)``.
    """

    def field(name: str, otherwise: Column) -> Column:
        return F.col(name) if name in pages.columns else otherwise

    no_id = F.lit(None).cast("bigint")
    contributor = F.struct(field("contributor_id", no_id).alias("id"))
    revision = F.array(
        F.struct(
            field("revision_id", no_id).alias("id"),
            contributor.alias("contributor"),
            one_line(F.col("text")).alias("text"),
        )
    )
    if "older" in pages.columns:
        revision = F.concat(
            F.transform(
                "older",
                lambda r: F.struct(
                    r["id"].cast("bigint").alias("id"),
                    F.struct(r["contributor_id"].cast("bigint").alias("id")).alias("contributor"),
                    one_line(r["text"]).alias("text"),
                ),
            ),
            revision,
        )
    page = F.struct("title", "ns", F.col("page_id").alias("id"), revision.alias("revision"))
    xml = F.to_xml(page, {"rowTag": "page", "indent": ""})
    return pages.select(F.regexp_replace(xml, r"\n", "").alias("value"))


def main_namespace(pages: DataFrame) -> DataFrame:
    """Only articles: namespace 0."""
    return pages.where(F.col("ns") == "0")


def revision_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, title, text)`` of every revision, not of the last one only."""
    return pages.select("page_id", "title", F.explode("revisions.text").alias("text"))


def header_rows(pages: DataFrame) -> DataFrame:
    """``title`` (ASCII part) and every ``id`` below a page, one row each."""
    title = F.struct(F.lit("title").alias("kind"), drop_non_ascii(F.col("title")).alias("value"))
    no_ids = F.array().cast("array<bigint>")
    ids = F.concat(
        F.array("page_id"),
        F.coalesce("revisions.id", no_ids),
        F.coalesce("revisions.contributor_id", no_ids),
    )
    items = F.concat(
        F.array(title),
        F.transform(
            ids, lambda i: F.struct(F.lit("id").alias("kind"), i.cast("string").alias("value"))
        ),
    )
    return (
        pages.select("page_id", F.inline(items))
        .where("value is not null")
        .select("page_id", "kind", "value")
    )

"""Links and the simplified PageRank.

A link table has ``src`` and ``dst``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.plans.staging import cut, stage, stage_bucketed

#: Links of one source that one task may hold; a hub's links are split beyond it.
LINKS_PER_SPLIT = 100_000

#: Links that one bucket is meant to hold in the rounds.
LINKS_PER_BUCKET = 500_000


def distinct_links(links: DataFrame) -> DataFrame:
    return links.select("src", "dst").distinct()


def out_degree(links: DataFrame) -> DataFrame:
    """``(src, n_links)`` over distinct links."""
    return distinct_links(links).groupBy("src").agg(F.count("*").alias("n_links"))


def ranks(
    links: DataFrame,
    rounds: int,
    damping: float = 0.80,
    base: float = 0.20,
    links_per_split: int = LINKS_PER_SPLIT,
    cut_every: int = 5,
    links_per_bucket: int = LINKS_PER_BUCKET,
) -> DataFrame:
    """``(page, rank)`` after ``rounds`` rounds.

    Pages with links out start at 1.  A round gives each page
    ``base + damping * sum(rank / out-degree)`` over the pages that link to it;
    pages nobody links to have no rank after it, pages without links out have
    one but pass nothing on.

    The links of a hub are dealt over ``splits`` parts, and the hub's rank goes
    to each, so no join group exceeds ``links_per_split``.  Contributions are
    summed before they are shuffled, which takes care of much-linked pages.  Links
    are bucketed once, so a round shuffles ranks and sums but not the links.
    """
    distinct = stage(distinct_links(links), "links")
    sources = stage(
        distinct.groupBy("src")
        .agg(F.count("*").alias("n_links"))
        .withColumn("splits", F.ceil(F.col("n_links") / links_per_split).cast("int")),
        "sources",
    )
    part = F.pmod(F.xxhash64("dst"), F.col("splits")).cast("int")
    edges = distinct.join(sources, "src").select("src", part.alias("part"), "dst")
    buckets = max(1, -(-distinct.count() // links_per_bucket))
    edges = stage_bucketed(edges, "edges", buckets, "src", "part")
    current = sources.select(F.col("src").alias("page"), F.lit(1.0).alias("rank"))
    for done in range(1, rounds + 1):
        shares = current.withColumnRenamed("page", "src").join(sources, "src").select(
            "src",
            F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("part"),
            (F.col("rank") / F.col("n_links")).alias("share"),
        )
        current = (
            edges.join(shares, ["src", "part"])
            .groupBy(F.col("dst").alias("page"))
            .agg((F.sum("share") * damping + base).alias("rank"))
        )
        if done % cut_every == 0 and done < rounds:
            current = cut(current)
    return current


def top_pages(ranked: DataFrame, titles: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` highest ranks with their titles, shown in ascending order."""
    best = ranked.orderBy(F.desc(F.round("rank", 9)), "page").limit(k)
    return best.join(titles, "page", "left").orderBy(F.round("rank", 9), F.desc("page"))


def links_between(links: DataFrame, chosen: DataFrame, either: bool = False) -> DataFrame:
    """Links whose ends are both among ``chosen.page`` (or one, with ``either``)."""
    src = chosen.select(F.col("page").alias("src"))
    dst = chosen.select(F.col("page").alias("dst"))
    if not either:
        kept = links.join(src, "src", "left_semi").join(dst, "dst", "left_semi")
        return kept.select("src", "dst")
    marked = links.join(src.withColumn("has_src", F.lit(True)), "src", "left").join(
        dst.withColumn("has_dst", F.lit(True)), "dst", "left"
    )
    return marked.where("has_src or has_dst").select("src", "dst")

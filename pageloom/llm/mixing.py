"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

**Targets.**  A source's weight gives its share of the words wanted; a target above the
cap (two times the source's words) is cut to it and the excess is shared out again by
weight, until none is above.  Sorted by size over weight, the capped sources come first,
so running sums find them in one pass over the table of sources, in whole numbers.

**Blocks.**  A keyed hash of the document id deals the documents of a source over 4096
blocks, in an order that has nothing to do with the input's.  A source takes whole
passes over its blocks as far as its target goes, and in the last pass a prefix of the
block order; the last block of that prefix is cut inside, within one document, so that
the words taken are the target, rounded down.  Block sums need one small row per block,
so a source with a third of all rows is 4096 groups, not one.  A document finds its block's
row by a join on the blocks; only in the cut blocks, one per source, are documents put in
order, as narrow rows, to find the document where the cut lies.  The table of blocks
does not grow with the documents of a source: up to ``FEW_BLOCKS`` rows are broadcast, so
texts stay where they are read, and only with more sources may they pass one shuffle.

**Shards.**  The taken blocks of all sources are split over the output shards by a
binary tree.  A node hands its left half exactly its share of blocks; how many come from
each source is a draw from the multivariate hypergeometric distribution, made source by
source from univariate ones by inverting their distribution function at a keyed hash.  A
shard's quotas add up to its size, and the quotas of all shards to the blocks taken.
Shards then draw disjoint runs of a source's permuted blocks, and order their documents
by another keyed hash.

All of it is DataFrame code.  The table of sources is one group (it is the recipe of the
mix); blocks and documents are not.

Defined cases: a null or empty text has size 0 and is taken 0 times; a null source is a
source of its own, the last one; null ids and repeated rows are documents like others;
rows of equal id and size share a place in the order, and if the cut lies there, each gives
the same words, so that less than one word for each of them is lacking at the target; with
no words at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.llm.text import SPACE_WORD, unused
from pageloom.plans.staging import stage

WEIGHTS = (3, 1, 2)
#: Words wanted, over all words, and the most a source or document gives.
SHARE = (3, 2)
CAP = 2
SHARDS = 16
SEED = "mix"
#: Hex digits of the hash that name a block: 16^3 blocks per source.
DIGITS = 3
#: Blocks that are broadcast to the texts: those of 64 sources, about 60 MB of memory.
FEW_BLOCKS = 1 << 18


def _named(source: Column) -> Column:
    """A source's name as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap: int = CAP) -> DataFrame:
    """``(source, source_size)`` with ``target`` and ``whole`` (the target rounded down).

    ``weights`` go to the sources by code point, null last, and repeat.
    """
    up, down = share
    named = Window.orderBy(F.col("source").asc_nulls_last())
    sized = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    upto = sized.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    w = F.get(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(named) - 1) % len(weights))
    rows = (
        sizes.withColumn("w", w.cast("long"))
        .withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("w").over(every))
        .withColumn("before_words", F.sum("source_size").over(upto) - F.col("source_size"))
        .withColumn("rest_weight", F.col("all_weight") - F.sum("w").over(upto) + F.col("w"))
    )
    # wanted words times `down`, less what the sources before have at most
    room = F.lit(up) * F.col("all_words") - F.lit(down * cap) * F.col("before_words")
    capped = F.col("source_size") * (down * cap) * F.col("rest_weight") < F.col("w") * room
    rows = (
        rows.withColumn("capped", capped)
        .withColumn("free", F.sum(F.when(~F.col("capped"), F.col("w"))).over(every))
        .withColumn("held", F.sum(F.when(F.col("capped"), F.col("source_size"))).over(every))
    )
    over = (F.lit(up) * F.col("all_words") - F.lit(down * cap) * F.coalesce("held", F.lit(0))) * F.col("w")
    under = F.lit(down) * F.col("free")
    return rows.select(
        "source",
        "source_size",
        F.when(F.col("capped"), (F.col("source_size") * cap).cast("double"))
        .otherwise(over.cast("double") / under.cast("double"))
        .alias("target"),
        F.when(F.col("capped"), F.col("source_size") * cap)
        .otherwise(F.expr("1") * F.floor(over.cast("double") / under.cast("double")))
        .cast("long")
        .alias("whole"),
    )


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a keyed hash."""
    head = F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 12), 16, 10)
    return (head.cast("double") + 0.5) / float(1 << 48)


def hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """The smallest ``k`` whose distribution function reaches ``u``.

    ``k`` of ``drawn`` balls out of ``total`` are among the ``good`` ones.  Weights are
    followed in logarithms from the smallest ``k`` on, first for their largest value,
    then for their sum, then up to ``u`` of it.
    """
    share = good / F.greatest(total, F.lit(1))
    mean = drawn * share
    spread = F.sqrt(mean * (1 - share) * (total - drawn) / F.greatest(total - 1, F.lit(1)))
    # u has 48 bits: what lies farther out than this is less than its last one
    room = spread * 12 + 12
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - good), F.floor(mean - room))
    high = F.least(drawn, good, F.ceil(mean + room))
    steps = F.sequence(low, high)

    def ratio(k: Column) -> Column:
        """Logarithm of the weight of ``k`` over that of ``k - 1``."""
        up = (good - k + 1) * (drawn - k + 1)
        down = k * (total - good - drawn + k)
        return F.when(k > low, F.log(up.cast("double")) - F.log(down.cast("double"))).otherwise(F.lit(0.0))

    zero = F.lit(0.0)
    top = F.aggregate(
        steps,
        F.struct(zero.alias("at"), zero.alias("top")),
        lambda s, k: F.struct(
            (s["at"] + ratio(k)).alias("at"),
            F.greatest(s["top"], s["at"] + ratio(k)).alias("top"),
        ),
        lambda s: s["top"],
    )
    mass = F.aggregate(
        steps,
        F.struct(zero.alias("at"), zero.alias("sum"), top.alias("top")),
        lambda s, k: F.struct(
            (s["at"] + ratio(k)).alias("at"),
            (s["sum"] + F.exp(s["at"] + ratio(k) - s["top"])).alias("sum"),
            s["top"].alias("top"),
        ),
        lambda s: F.struct(s["sum"].alias("sum"), s["top"].alias("top")),
    )
    none = F.lit(-1).cast("long")
    return F.aggregate(
        steps,
        F.struct(zero.alias("at"), zero.alias("sum"), none.alias("k"), mass.alias("m")),
        lambda s, k: F.struct(
            (s["at"] + ratio(k)).alias("at"),
            (s["sum"] + F.exp(s["at"] + ratio(k) - s["m"]["top"])).alias("sum"),
            F.when(
                (s["k"] < 0)
                & (
                    (s["sum"] + F.exp(s["at"] + ratio(k) - s["m"]["top"]) >= u * s["m"]["sum"])
                    | (k == high)
                ),
                k,
            )
            .otherwise(s["k"])
            .alias("k"),
            s["m"].alias("m"),
        ),
        lambda s: s["k"],
    )


def quotas(counts: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``(source, n)`` split over shards: ``(shard, source, quota)``.

    One row per tree node holds the list of its sources' counts, which is as long as the
    recipe; a level of the tree is one projection.
    """
    node = counts.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("source", F.col("n").cast("long").alias("n")))).alias("c")
    )
    node = node.select(F.lit(0).alias("first"), F.lit(shards).alias("width"), "c")
    while True:
        wide = F.col("width") > 1
        half = F.expr("width div 2")
        total = F.aggregate("c", F.lit(0).cast("long"), lambda s, x: s + x["n"])
        # cut at the rounded-down share, so that shards differ by at most a block or two
        drawn = F.expr("1") * F.floor(total * half / F.col("width")).cast("long")
        empty = F.expr("CAST(array() AS array<bigint>)")

        def draw(s: Column, x: Column) -> Column:
            u = _uniform(
                F.lit(seed),
                F.col("first").cast("string"),
                F.col("width").cast("string"),
                F.coalesce(x["source"], F.lit("\x00")),
            )
            k = hypergeometric(s["total"], x["n"], s["drawn"], u)
            return F.struct(
                (s["total"] - x["n"]).alias("total"),
                (s["drawn"] - k).alias("drawn"),
                F.concat(s["out"], F.array(k)).alias("out"),
            )

        left = F.aggregate(
            "c",
            F.struct(total.alias("total"), drawn.alias("drawn"), empty.alias("out")),
            draw,
            lambda s: s["out"],
        )
        if shards <= 1:
            break
        split = node.withColumn("l", F.when(wide, left))
        pick = lambda of: F.zip_with(
            "c", "l", lambda x, k: F.struct(x["source"].alias("source"), of(x["n"], k).alias("n"))
        )
        children = F.when(
            wide,
            F.array(
                F.struct(F.col("first"), half.cast("int").alias("width"), pick(lambda n, k: k).alias("c")),
                F.struct(
                    (F.col("first") + half).cast("int").alias("first"),
                    (F.col("width") - half).cast("int").alias("width"),
                    pick(lambda n, k: n - k).alias("c"),
                ),
            ),
        ).otherwise(F.array(F.struct("first", "width", "c")))
        node = stage(split.select(F.inline(children)), "split")
        shards = -(-shards // 2)
    return node.select(F.col("first").alias("shard"), F.inline("c")).withColumnRenamed("n", "quota")


def draws(sizes: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """What the mix takes of every block of documents.

    ``sizes`` has one row per document: ``source, block, size``.  The result has one row
    per block with words: ``source, block, n, source_size, target, draws``; ``n`` are its
    words, and a draw is ``(copy, shard, upto)``, where ``upto`` are the words taken from the
    block's start: all of them but in one draw per source.
    """
    blocks = stage(sizes.groupBy("source", "block").agg(F.sum("size").alias("n")), "blocks")
    by_source = blocks.groupBy("source").agg(F.sum("n").alias("source_size"))
    recipe = stage(targets(by_source), "recipe")
    order = Window.partitionBy("source").orderBy("block")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = blocks["source"].eqNullSafe(recipe["source"])
    placed = (
        blocks.join(recipe, same)
        .select(blocks["source"], "block", "n", "source_size", "target", "whole")
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
    )
    # pass c takes the words from c * source_size on, as far as the target goes
    passes = F.sequence(F.lit(0), F.lit(CAP - 1))
    room = F.col("whole") - F.col("copy") * F.col("source_size") - F.col("before")
    taken = stage(
        placed.withColumn("copy", F.explode(passes)).withColumn(
            "upto", F.greatest(F.lit(0), F.least(F.col("n"), room)).cast("long")
        ),
        "taken",
    )
    used = taken.where("upto > 0")
    shares = quotas(used.groupBy("source").agg(F.count("*").alias("n")), shards, seed)
    until = Window.partitionBy("source").orderBy("shard")
    ends = shares.withColumn("to", F.sum("quota").over(until)).select(
        F.col("source").alias("s"), "shard", (F.col("to") - F.col("quota")).alias("from"), "to"
    )
    ranges = ends.groupBy("s").agg(
        F.array_sort(F.collect_list(F.struct("to", "from", "shard"))).alias("ends")
    )
    permuted = Window.partitionBy("source").orderBy(
        F.md5(F.concat_ws("|", F.lit(seed), F.col("block"), F.col("copy")).cast("binary"))
    )
    numbered = used.withColumn("i", F.row_number().over(permuted))
    drawn = numbered.join(ranges, F.col("source").eqNullSafe(F.col("s"))).select(
        "source",
        "block",
        "copy",
        "upto",
        F.filter("ends", lambda e: F.col("i") <= e["to"])[0]["shard"].alias("shard"),
    )
    key = ["source", "block"]
    of_block = drawn.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("copy", "shard", "upto"))).alias("draws")
    )
    a, b = taken.where("copy = 0").alias("a"), of_block.alias("b")
    nothing = F.expr("CAST(array() AS array<struct<copy: int, shard: int, upto: bigint>>)")
    return a.join(
        b,
        F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.block") == F.col("b.block")),
        "left",
    ).select(
        "a.source",
        "a.block",
        "a.n",
        "a.source_size",
        "a.target",
        F.coalesce("b.draws", nothing).alias("draws"),
    )


def cuts(sizes: DataFrame, found: DataFrame) -> DataFrame:
    """Where the cut lies in the blocks that are taken in part: ``name, block, at, each``.

    ``at`` is the place ``(h, size)`` of the rows that are cut, and ``each`` the words taken
    of each of them; rows before them are taken whole, rows behind them not at all.  Rows
    of equal place are one row before they are put in order.
    """
    partial = F.get(F.filter("draws", lambda d: d["upto"] < F.col("n")), F.lit(0))["upto"]
    wanted = found.select("name", "block", partial.alias("upto")).where("upto IS NOT NULL")
    places = (
        sizes.where("size > 0")
        .join(wanted, ["name", "block"])
        .groupBy("name", "block", "upto", "h", "size")
        .agg(F.count("*").alias("rows"))
    )
    inside = Window.partitionBy("name", "block").orderBy("h", "size")
    ends = F.sum(F.col("size") * F.col("rows")).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        places.withColumn("before", ends - F.col("size") * F.col("rows"))
        .withColumn("left", F.col("upto") - F.col("before"))
        .where("left > 0 AND left <= size * rows")
        .select("name", "block", F.struct("h", "size").alias("at"), F.expr("left DIV rows").alias("each"))
    )


def mix(
    docs: DataFrame,
    out: str,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    shards: int = SHARDS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with a struct column ``out``.

    ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted) and
    ``parts``: an array of ``(copy, shard, words, place)``, where ``words`` are the words
    taken from the text's start (all of them but for one document per source) and
    ``place`` orders the documents of a shard.
    """
    h = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    m = unused(docs, f"{out}__", prefix=True)
    own = docs.withColumn(
        m,
        F.struct(
            F.col(source).alias("source"),
            _named(F.col(source)).alias("name"),
            h.alias("h"),
            F.substring(h, 1, DIGITS).alias("block"),
            word_count(F.col(text)).alias("size"),
        ),
    )
    sizes = stage(own.select(f"`{m}`.*"), "sizes")
    found = stage(draws(sizes, shards, seed).withColumn("name", _named(F.col("source"))), "draws")
    found = found.join(cuts(sizes, found), ["name", "block"], "left")
    found = stage(found.drop("source"), "cut-draws")
    few = found.limit(FEW_BLOCKS + 1).count() <= FEW_BLOCKS
    found = found.select(F.struct("*").alias(f"{m}b"))
    found = F.broadcast(found) if few else found
    mine, theirs = F.col(f"`{m}`"), F.col(f"`{m}b`")
    joined = own.join(
        found, (mine["name"] == theirs["name"]) & (mine["block"] == theirs["block"])
    )
    place, cut = F.struct(mine["h"].alias("h"), mine["size"].alias("size")), theirs["at"]
    of_cut = F.when(place < cut, mine["size"]).when(place == cut, theirs["each"]).otherwise(0)
    parts = F.filter(
        F.transform(
            theirs["draws"],
            lambda d: F.struct(
                d["copy"].alias("copy"),
                d["shard"].alias("shard"),
                F.when(d["upto"] >= theirs["n"], mine["size"]).otherwise(of_cut).alias("words"),
                F.md5(
                    F.concat_ws("|", F.lit(seed), d["shard"], d["copy"], mine["h"]).cast("binary")
                ).alias("place"),
            ),
        ),
        lambda p: p["words"] > 0,
    )
    joined = joined.withColumn(f"{m}p", parts)
    taken = F.aggregate(F.col(f"`{m}p`"), F.lit(0).cast("long"), lambda s, p: s + p["words"])
    return joined.withColumn(
        out,
        F.struct(
            mine["size"].alias("size"),
            theirs["source_size"].alias("source_size"),
            theirs["target"].alias("target"),
            taken.alias("taken"),
            F.col(f"`{m}p`").alias("parts"),
        ),
    ).drop(m, f"{m}b", f"{m}p")


def query(spark, sf_dir: str) -> DataFrame:
    """op10: what the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    x = mix(docs, "m")
    return x.select("doc_id", "m.size", "m.source_size", "m.target", "m.taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, sum(source_size) OVER () AS t,
         sum(source_size) OVER o - source_size AS before,
         sum(w) OVER () - sum(w) OVER o + w AS rest
  FROM s WINDOW o AS (ORDER BY source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
k AS (SELECT *, source_size * 4 * rest < w * (3 * t - 4 * before) AS capped FROM c),
f AS (
  SELECT *, sum(CASE WHEN NOT capped THEN w END) OVER () AS free,
         coalesce(sum(CASE WHEN capped THEN source_size END) OVER (), 0) AS held FROM k),
g AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST((3 * t - 4 * held) * w AS DOUBLE) / CAST(2 * free AS DOUBLE) END AS target
  FROM f),
p AS (
  SELECT d.*, source_size, target, CAST(floor(target) AS BIGINT) AS whole,
         sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS UNBOUNDED PRECEDING) - size AS ahead
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, whole - ahead)) + greatest(0, least(size, whole - source_size - ahead)) AS BIGINT) AS taken
FROM p
"""

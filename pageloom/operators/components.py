"""Connected components of an undirected graph.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every round hooks vertices to the
lowest neighbour they know, so the number of rounds grows with the logarithm of
the diameter, not with the diameter itself.

Every component ends up as a star, so its lowest vertex becomes a hub with as
many edges as the component has vertices.  The per-vertex minimum is combined
before it is shuffled.  In a large graph it is then staged, so that the join
back on the vertex has a plain shuffle on both sides, which AQE splits at a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.plans.staging import stage, unstage


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(
        F.struct(F.col("u").alias("u"), F.col("v").alias("v")),
        F.struct(F.col("v").alias("u"), F.col("u").alias("v")),
    )
    return edges.select(F.inline(ends))


def _lowest(neighbours: DataFrame) -> DataFrame:
    """Per vertex the lowest of itself and its neighbours."""
    lowest = neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return stage(lowest, "lowest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hook every higher neighbour to the lowest one."""
    around = _both_ways(edges)
    lowest = _lowest(around)
    hooked = (
        around.where("v > u")
        .join(lowest, "u")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
        .where("u <> v")
        .distinct()
    )
    return _finish(hooked, "large-star", lowest)


def _small_star(edges: DataFrame) -> DataFrame:
    """Hook a vertex and its lower neighbours to the lowest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = _lowest(down)
    hooked = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = lowest.select("u", F.col("low").alias("v"))
    return _finish(hooked.unionByName(own).where("u <> v").distinct(), "small-star", lowest, edges)


def _finish(df: DataFrame, name: str, *used: DataFrame) -> DataFrame:
    out = stage(df, name)
    for table in used:
        unstage(table)
    return out


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(vertex, component)`` for every vertex of an edge ``(u, v)``.

    A component is named by its lowest vertex.  Only two numbers per round reach
    the driver; the edges of each round are staged.
    """
    simple = edges.where("u <> v").select("u", "v").distinct()
    current = stage(simple, "edges")
    seen = _fingerprint(current)
    for _ in range(max_rounds):
        hooked = _large_star(current)
        unstage(current)
        current = _small_star(hooked)
        now = _fingerprint(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no stable components after {max_rounds} rounds")
    roots = current.select(F.col("v").alias("vertex")).distinct()
    return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(
        roots.select("vertex", F.col("vertex").alias("component"))
    )

"""Embedding near-duplicates by a forest of random-projection trees.

Two vectors link if their cosine (in doubles) is at least ``cosine``.

1. **Classes.**  Equal vectors are one class, however many rows hold them.
2. **Trees.**  A cell with more than ``LEAF`` classes is split at the median of its
   projections on a random direction.  What lies within the *spill* width of the median
   goes to both sides, so that near vectors are seldom parted; what one tree parts,
   others join.  The splits of a cell are fitted on a hashed sample of its classes (about
   ``SAMPLE``, several levels at once) and then route every class; cells that are still
   too large are split again in the next round.  A cell that no direction divides (near
   copies of one vector) stays as it is.
3. **Compare.**  All classes of a leaf are compared.  A leaf beyond ``TILE`` classes is a
   grid of tiles, each a group of its own, so that no task gets an unbounded group.
4. **Count once.**  A pair may meet in several leaves.  Every class carries the list of
   its leaves, and a pair counts in the lowest leaf that both share; so links are summed
   per class and no pair is written.
5. **Union.**  A tile gives one edge per class to the lowest class that it reaches there;
   components of these edges are the components of all links found.

The directions follow from the seed, the cell and the node, so that only thresholds
travel: a pass broadcasts the splits of at most ``PASS_CELLS`` cells of at most
``2^(DEPTH+1)`` nodes.

Recall is measured against all pairs in the tests and the README.  No link is reported
below the cosine.

Defined cases: a null, empty or zero vector, or one with a null or non-finite component,
links with nothing and is a component of its own; vectors of different lengths do not
link; repeated ids are vectors of their own, each with links to the others; a component
whose ids are all null has a null id and keeps nothing; an empty table has no rows.  No
other column is read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.operators.components import components
from pageloom.plans.staging import stage

COSINE = 0.95
TREES = 6
SEED = 13
#: Classes of a leaf, from which it is split again.
LEAF = 1024
#: Classes of one tile; larger leaves are grids of tiles.
TILE = 2048
#: Classes on which the splits of one cell are fitted, on average.
SAMPLE = 16_384
#: Sampled classes below which a node is not split in this round.
LEAST = 32
#: Levels split per round.
DEPTH = 10
#: Half the spill, in standard deviations of a linked pair's projected distance.
SPILL = 0.5
#: A split must leave at most this part of the classes on either side.
PROGRESS = 0.8
#: Directions tried at a node.
TRIES = 3
#: Cells whose splits are broadcast at once.
PASS_CELLS = 4096
#: Rows compared with a tile at once, and found pairs looked at together.
BLOCK, PAIRS = 512, 1 << 16
#: Cell numbers gain 12 bits a round; beyond this, cells are split no more.
LAST_CELL = 1 << 50

NODES = "array<struct<threshold:double,left:int,right:int,way:int>>"


def direction(seed: int, cell: int, node: int, way: int, width: int) -> np.ndarray:
    rnd = np.random.default_rng([seed, cell, node, way])
    out = rnd.standard_normal(width)
    return out / np.linalg.norm(out)


def half_spill(cosine: float, width: int, spill: float = SPILL) -> float:
    """Half the width of the strip that goes to both sides."""
    return spill * math.sqrt(max(2 - 2 * cosine, 0.0) / width)


def unit(vectors: pa.Array) -> np.ndarray:
    """Rows of one length scaled to length 1, in doubles."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    rows = flat.reshape(len(vectors), -1).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def grow(sample: np.ndarray, n: int, cell: int, seed: int, strip: float, leaf: int) -> list[tuple]:
    """Splits of a cell of ``n`` classes: ``(threshold, left, right, way)`` per node.

    A leaf has ``left = -1`` and its number as ``right``; its threshold is 1 if no
    direction divides it, else 0.
    """
    nodes: list[tuple] = []
    share = n / max(len(sample), 1)
    leaves = 0

    def split(own: np.ndarray, depth: int) -> int:
        nonlocal leaves
        at = len(nodes)
        nodes.append(())
        few = len(own) * share <= leaf or len(own) < LEAST or depth == DEPTH
        for way in range(0 if few else TRIES):
            p = own @ direction(seed, cell, at, way, own.shape[1])
            middle = float(np.median(p))
            left, right = p <= middle + strip, p >= middle - strip
            if max(left.sum(), right.sum()) <= PROGRESS * len(own):
                below = split(own[left], depth + 1)
                nodes[at] = (middle, below, split(own[right], depth + 1), way)
                return at
        nodes[at] = (0.0 if few else 1.0, -1, leaves, 0)
        leaves += 1
        return at

    split(sample, 0)
    return nodes


def leaves_of(rows: np.ndarray, nodes: list[tuple], cell: int, seed: int, strip: float):
    """``(row numbers, leaf)`` of the leaves that the rows reach; negative: not divisible."""
    todo = [(0, np.arange(len(rows)))]
    while todo:
        at, own = todo.pop()
        threshold, left, right, way = nodes[at]
        if left < 0:
            new = cell * 4096 + right + 1
            yield own, -new if threshold else new
            continue
        p = rows[own] @ direction(seed, cell, at, way, rows.shape[1])
        for child, inside in ((left, p <= threshold + strip), (right, p >= threshold - strip)):
            if inside.any():
                todo.append((child, own[inside]))


def _fit(seed: int, cosine: float, leaf: int):
    def run(key, table):
        sample = unit(table["v"].combine_chunks())
        cell, n = key[0].as_py(), table["n"][0].as_py()
        strip = half_spill(cosine, sample.shape[1])
        nodes = grow(sample, n, cell, seed, strip, leaf)
        names = ("threshold", "left", "right", "way")
        rows = [dict(zip(names, x, strict=True)) for x in nodes]
        kind = pa.struct([("threshold", pa.float64()), *((x, pa.int32()) for x in names[1:])])
        return pa.table({"cell": pa.array([cell], pa.int64()), "nodes": pa.array([rows], pa.list_(kind))})

    return run


def _route(held, seed: int, cosine: float):
    """The cells of a row, those with splits replaced by the leaves reached."""

    @F.arrow_udf("array<long>")
    def route(vectors: pa.Array, cells: pa.Array) -> pa.Array:
        splits = held.value
        out: list[list[int]] = [[] for _ in range(len(vectors))]
        members: dict[int, list[int]] = {}
        for i, own in enumerate(cells.to_pylist()):
            for cell in own:
                if cell in splits:
                    members.setdefault(cell, []).append(i)
                else:
                    out[i].append(cell)
        for cell, at in members.items():
            rows = unit(vectors.take(pa.array(at)))
            strip = half_spill(cosine, rows.shape[1])
            for own, leaf in leaves_of(rows, splits[cell], cell, seed, strip):
                for i in own.tolist():
                    out[at[i]].append(leaf)
        return pa.array(out, pa.list_(pa.int64()))

    return route


def forest(
    classes: DataFrame, cosine: float, trees: int, seed: int, leaf: int, sample: int
) -> DataFrame:
    """``classes`` (``c, v, n``) with ``cells``: the leaves of each class in all trees."""
    first = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.size("v").cast("long") * 64 + t
    )
    state = classes.withColumn("cells", first)
    while True:
        sizes = state.select(F.explode("cells").alias("cell")).groupBy("cell").count()
        large = (F.col("count") > leaf) & (F.col("cell") > 0) & (F.col("cell") < LAST_CELL)
        over = stage(sizes.where(large).select("cell", F.col("count").alias("n")), "large-cells")
        total = over.count()
        if not total:
            return state
        part = F.pmod(F.xxhash64("c", "cell", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        chosen = (
            state.select("c", "v", F.explode("cells").alias("cell"))
            .join(over, "cell")
            .where(part < F.lit(float(sample)) / F.col("n"))
            .select("cell", "n", "v")
        )
        fitted = chosen.groupBy("cell").applyInArrow(_fit(seed, cosine, leaf), f"cell long, nodes {NODES}")
        fitted = stage(fitted, "splits")
        passes = -(-total // PASS_CELLS)
        for p in range(passes):
            own = fitted.where(F.pmod(F.xxhash64("cell"), F.lit(passes)) == p)
            splits = {r["cell"]: [tuple(x) for x in r["nodes"]] for r in own.toLocalIterator()}
            held = state.sparkSession.sparkContext.broadcast(splits)
            state = stage(state.withColumn("cells", _route(held, seed, cosine)("v", "cells")), "cells")


def _padded(lists: pa.Array) -> np.ndarray:
    """Rows of different lengths as a matrix, filled with zeros (no cell has number 0)."""
    sizes = lists.value_lengths().to_numpy()
    out = np.zeros((len(lists), int(sizes.max(initial=1))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row the lowest cell in both lists."""
    most = np.iinfo(np.int64).max
    both = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a != 0)
    return np.where(both, a, most).min(axis=1)


def _spread(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lowest label reachable over the pairs, given labels that are row numbers."""
    while True:
        new = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _compare(cosine: float):
    """Links and edges of one tile."""

    def run(key, table):
        cell, low, high = (x.as_py() for x in key)
        c, n, chunk = (table[x].combine_chunks().to_numpy() for x in ("c", "n", "chunk"))
        rows, cells = unit(table["v"].combine_chunks()), _padded(table["cells"].combine_chunks())
        links, label = np.zeros(len(c), np.int64), np.arange(len(c))
        ones, others = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        for at in range(0, len(ones), BLOCK):
            a = ones[at : at + BLOCK]
            i, j = np.nonzero(rows[a] @ rows[others].T >= cosine)
            i, j = a[i], others[j]
            if low == high:  # every pair once, none with itself
                i, j = i[i < j], j[i < j]
            if len(i):
                label = _spread(label, i, j)
            for k in range(0, len(i), PAIRS):
                x, y = i[k : k + PAIRS], j[k : k + PAIRS]
                here = _first_shared(cells[x], cells[y]) == cell
                np.add.at(links, x[here], n[y[here]])
                np.add.at(links, y[here], n[x[here]])
        used = np.flatnonzero((links > 0) | (label != np.arange(len(c))))
        return pa.table({"c": c[used], "links": links[used], "root": c[label[used]]})

    return run


def met(rows: DataFrame, cosine: float, tile: int) -> DataFrame:
    """``(c, links, root)``: links that count in a tile, and the class it hangs on there."""
    dealt = rows.select("c", "v", "n", "cells", F.explode("cells").alias("cell"))
    sizes = rows.select(F.explode("cells").alias("cell")).groupBy("cell").count()
    wide = stage(
        sizes.where(F.col("count") > tile)
        .select("cell", F.ceil(F.col("count") / tile).cast("int").alias("parts")),
        "wide-cells",
    )
    dealt = dealt.join(wide, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("c", F.lit(1)), F.col("parts")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(
        "cell", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
        "c", "n", "chunk", "v", "cells",
    )
    tiles = dealt.groupBy("cell", "low", "high")
    return tiles.applyInArrow(_compare(cosine), "c long, links long, root long")


def usable(vector: Column) -> Column:
    """Vectors that can link: finite, without nulls, not zero."""
    inf = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    trees: int = TREES,
    seed: int = SEED,
    leaf: int = LEAF,
    tile: int = TILE,
    sample: int = SAMPLE,
) -> DataFrame:
    """``(id, n_links, component_id)`` per row of ``vectors``; at most 64 trees."""
    if not 1 <= trees <= 64:
        raise ValueError("1 to 64 trees")
    v = F.col(vector)
    name = F.unhex(F.sha2(F.concat_ws(",", v.cast("array<string>")), 256))
    rows = vectors.select(F.col(key).alias("id"), v.alias("v"), F.when(usable(v), name).alias("key"))
    ids = stage(rows.select("id", "key"), "vector-keys")
    grouped = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("id")
    )
    classes = stage(grouped.withColumn("c", F.monotonically_increasing_id()), "vector-classes")
    leaves = forest(classes.select("c", "v", "n"), cosine, trees, seed, leaf, sample)
    found = stage(met(leaves, cosine, tile), "links")
    degree = found.groupBy("c").agg(F.sum("links").alias("links"))
    edges = found.where("c <> root").select(F.col("c").alias("u"), F.col("root").alias("v")).distinct()
    linked = components(edges).withColumnRenamed("vertex", "c")
    named = classes.select("key", "c", "n", "id").join(degree, "c", "left").join(linked, "c", "left")
    named = stage(
        named.select(
            "key", "id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "c").alias("component"),
        ),
        "named-classes",
    )
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = stage(named.join(lowest, "component").select("key", "n_links", "component_id"), "components")
    alone = ids.where("key IS NULL").select("id", F.lit(0).cast("long").alias("n_links"))
    return (
        ids.where("key IS NOT NULL").join(named, "key").select("id", "n_links", "component_id")
        .unionByName(alone.withColumn("component_id", F.col("id")))
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op13: links and component of every embedding, whatever its label."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component_id").cast("long").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )

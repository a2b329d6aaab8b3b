"""Centroid clustering in exact whole numbers, filtered by n-simplex projection.

Vectors become whole numbers, ``floor(scale * x)``.  Lloyd rounds assign every vector to
its nearest centroid (squared Euclidean distance, ties to the smaller number) and move a
centroid to the floored mean of its vectors.

**Filter** (after Connor et al., "High-dimensional simplexes for supermetric search",
2017).  A few vectors are pivots.  Their mutual distances fix a simplex, and a vector's
distances to them fix the *apex* over that base: coordinates in as many dimensions as
there are pivots, computed once and kept.  For two vectors, the distance of their apexes
bounds their true distance from below, and with the sign of the last coordinate turned it
bounds it from above.  A round projects the centroids too; a centroid whose lower bound
is above the least upper bound cannot be nearest, and only those left are compared, in
64-bit whole numbers.  Bounds are taken with some slack for rounding, so the filter never
decides a tie.

Pivots are chosen among the vectors with the smallest hashes: each next one is that which
stands highest over the simplex so far, which keeps the projection well conditioned;
copies and dependent vectors cannot become pivots.

A round is one scan of the staged vectors; each task sends at most one sum per cluster
and component, and ``k`` centroids reach the driver.  Vectors are never shuffled.

Defined cases: a vector that is null, has another number of components, or a null or
non-finite one, is not kept and has no row, likewise one with a whole number beyond
:func:`largest` (``2^27`` for 64 components; its squared distances need not fit a long); with fewer kept vectors
than ``k`` there are as many clusters as vectors; equal vectors may start several
centroids, of which the smallest number gets all; repeated ids are vectors of their own,
a null id is hashed as the word ``null``; an empty table has no rows.  No other column is
read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.plans.staging import stage

K = 8
ROUNDS = 10
COMPONENTS = 64
SCALE = 1024
SEED = 3
#: Most pivots, and the vectors among which they are chosen.
PIVOTS = 12
POOL = 64
#: A pivot stands at least this high over the others, as a part of the first edge.
LEAST_HEIGHT = 1e-2
#: Relative slack of the squared bounds.
SLACK = 1e-5


def largest(components: int) -> int:
    """Whole numbers up to here keep squared distances below ``2^62``."""
    return min(math.isqrt((1 << 62) // components) // 2, (1 << 31) - 1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.stack([np.square(a - row).sum(axis=1) for row in b], axis=1)


class Simplex:
    """Apex coordinates over the simplex of a few pivots."""

    def __init__(self, pool: np.ndarray, most: int = PIVOTS):
        self.pivots = pool[self._choose(pool, most)]
        own = squared(self.pivots, self.pivots).astype(np.float64)
        self.first = own[0, 1:]
        gram = (own[0, 1:, None] + own[0, None, 1:] - own[1:, 1:]) / 2
        self.base = np.linalg.cholesky(gram) if len(gram) else gram

    @staticmethod
    def _choose(pool: np.ndarray, most: int) -> list[int]:
        chosen, rest = [0], (pool - pool[0]).astype(np.float64)
        first = None
        while len(chosen) < most:
            height = np.linalg.norm(rest, axis=1)
            top = int(height.argmax())
            first = first or height[top]
            if not height[top] > LEAST_HEIGHT * first:
                break
            chosen.append(top)
            unit = rest[top] / height[top]
            rest -= np.outer(rest @ unit, unit)
        return chosen

    def apex(self, rows: np.ndarray) -> np.ndarray:
        """One row of coordinates per vector; the last is its height over the base."""
        d = squared(rows, self.pivots).astype(np.float64)
        inner = (d[:, :1] + self.first - d[:, 1:]) / 2
        z = np.zeros_like(inner)
        for i in range(z.shape[1]):  # forward substitution
            z[:, i] = (inner[:, i] - z[:, :i] @ self.base[i, :i]) / self.base[i, i]
        height = np.sqrt(np.maximum(d[:, 0] - np.square(z).sum(axis=1), 0))
        return np.column_stack([z, height])


def possible(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids may be nearest to which rows, by the bounds of their apexes."""
    sizes, own = np.square(apexes).sum(axis=1)[:, None], np.square(centroids).sum(axis=1)
    lower = sizes + own - 2 * (apexes @ centroids.T)
    upper = lower + 4 * apexes[:, -1:] * centroids[:, -1]
    slack = SLACK * (sizes + own)
    return lower - slack <= (upper + slack).min(axis=1, keepdims=True)


def nearest(rows: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex):
    """``(number of the nearest centroid, squared distance, exact comparisons)``."""
    open_to = possible(apexes, simplex.apex(centroids))
    best = np.full(len(rows), np.iinfo(np.int64).max)
    label = np.zeros(len(rows), np.int32)
    for c, centroid in enumerate(centroids):
        at = np.flatnonzero(open_to[:, c])
        d = np.square(rows[at] - centroid).sum(axis=1)
        closer = d < best[at]
        best[at[closer]], label[at[closer]] = d[closer], c
    return label, best, int(open_to.sum())


def _matrix(column: pa.Array, kind) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False)


def whole(vector: Column, components: int, scale: int) -> Column:
    """The vector in whole numbers; null if it is not kept."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) <= largest(components)),
    )
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return F.when((F.size(vector) == components) & finite, numbers)


def _apexes(simplex: Simplex):
    @F.arrow_udf("array<double>")
    def apexes(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.float64()))
        z = simplex.apex(_matrix(vectors, np.int64))
        ends = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
        return pa.ListArray.from_arrays(ends, pa.array(z.ravel()))

    return apexes


SUMS = "cluster int, component int, total long, n long"


def _sums(centroids: np.ndarray, simplex: Simplex):
    """Per task: component sums and sizes of the clusters it meets."""

    def run(batches):
        k, width = centroids.shape
        total, n = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column(0), np.int64)
                label, _, _ = nearest(rows, _matrix(batch.column(1), np.float64), centroids, simplex)
                np.add.at(total, label, rows)
                n += np.bincount(label, minlength=k)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))),
                pa.array(total[used].ravel()),
                pa.array(np.repeat(n[used], width)),
            ],
            names=["cluster", "component", "total", "n"],
        )

    return run


def _assign(centroids: np.ndarray, simplex: Simplex):
    @F.arrow_udf("cluster int, distance long")
    def assign(vectors: pa.Array, apexes: pa.Array) -> pa.Array:
        label, d = np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(vectors):
            rows = _matrix(vectors, np.int64)
            label, d, _ = nearest(rows, _matrix(apexes, np.float64), centroids, simplex)
        return pa.StructArray.from_arrays([pa.array(label), pa.array(d)], ["cluster", "distance"])

    return assign


def move(rows: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round."""
    parts = rows.select("v", "apex").mapInArrow(_sums(centroids, simplex), SUMS)
    wide = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    moved = centroids.copy()
    for r in parts.groupBy("cluster", "component").agg(wide, F.sum("n").alias("n")).collect():
        moved[r["cluster"], r["component"]] = int(r["total"]) // r["n"]
    return moved


def cluster(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance)`` per kept vector, and the centroids."""
    if components < 1 or k < 1:
        raise ValueError("at least one component and one centroid")
    numbers = whole(F.col(vector), components, scale)
    kept = vectors.select(F.col(key).alias("id"), numbers.alias("v")).where("v IS NOT NULL")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    start = kept.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(max(k, POOL))
    pool = np.array([r["v"] for r in start.collect()], np.int64).reshape(-1, components)
    if not len(pool):
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), pool
    simplex = Simplex(pool, pivots)
    rows = stage(kept.select("id", "v", _apexes(simplex)("v").alias("apex")), "apexes")
    centroids = pool[:k]
    for _ in range(rounds):
        moved = move(rows, centroids, simplex)
        if np.array_equal(moved, centroids):
            break  # the rounds left would change nothing
        centroids = moved
    found = rows.select("id", _assign(centroids, simplex)("v", "apex").alias("a")).select("id", "a.*")
    return stage(found, "clusters"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    """op12: every kept embedding with its cluster; inertia per cluster and over all."""
    found, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    total = F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    sums = {r["cluster"]: int(r["inertia"]) for r in found.groupBy("cluster").agg(total).collect()}
    per_cluster = [
        (c, sums.get(c, 0), sum(sums.values()), digest(row)) for c, row in enumerate(centroids)
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    reports = spark.createDataFrame(per_cluster, schema)  # k rows
    columns = ("cluster_inertia", "inertia", "centroid_sha256")
    return found.join(F.broadcast(reports), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", *columns
    )


def _oracle(k: int = K, rounds: int = ROUNDS) -> str:
    parts = [
        r"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('3:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, m.c AS c, m.d AS d FROM kept JOIN (
    SELECT r, min({{'d': d, 'c': c}}) AS m FROM (
      SELECT k.r, o.c, list_sum(list_transform(list_zip(k.v, o.v),
               lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
      FROM kept k, c{i} o) GROUP BY r) USING (r))""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(f.v, o.v) AS v FROM c{i} o LEFT JOIN (
    SELECT c, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY j) AS v FROM (
      SELECT c, j, sum(x)::BIGINT AS s, count(*) AS n
      FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY c, j)
    GROUP BY c) f USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(o.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} o USING (c)
"""


ORACLE = _oracle()

"""k-means: Spark ML's, and a Lloyd iteration with given starting centres."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.plans.staging import stage


def l2_normalize(points: DataFrame, col: str = "features") -> DataFrame:
    """Scale every vector of ``col`` to unit length."""
    scaled = Normalizer(inputCol=col, outputCol="_unit", p=2.0).transform(points)
    return scaled.drop(col).withColumnRenamed("_unit", col)


def _trainer(k: int, max_iter: int, seed: int) -> KMeans:
    """Random start.  The row solver also copes with copies among the centres."""
    return KMeans(
        k=k,
        maxIter=max_iter,
        initMode="random",
        seed=seed,
        solver="row",
        predictionCol="cluster",
    )


def kmeans(
    points: DataFrame,
    k: int = 50,
    max_iter: int = 10,
    seeds: Sequence[int] = (1, 2),
    unit_length: bool = False,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``(page_id, cluster)`` and the centres of the best of several runs.

    ``points`` is ``(page_id, features)``.  One run per seed, random starting
    centres; the run with the lowest cost is kept.  The centres are dense, so
    they take ``k * dimensions`` numbers on the driver and on every executor:
    hash words to 2^12 - 2^16 features rather than 2^20.
    """
    base = l2_normalize(points) if unit_length else points
    base = stage(base.select("page_id", "features"), "features")
    models = [_trainer(k, max_iter, seed).fit(base) for seed in seeds]
    best = min(models, key=lambda m: m.summary.trainingCost)
    return best.transform(base).select("page_id", "cluster"), best.clusterCenters()


def _nearest(centres: np.ndarray):
    """The index of the nearest centre; distances are rounded to nine digits."""

    @F.arrow_udf("int")
    def nearest(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        rows = flat.reshape(len(vectors), centres.shape[1])
        dist = np.stack([np.square(rows - c).sum(axis=1) for c in centres])
        return pa.array(np.round(dist, 9).argmin(axis=0), type=pa.int32())

    return nearest


def lloyd(points: DataFrame, centres: Sequence[Sequence[float]], rounds: int) -> DataFrame:
    """``(id, cluster)`` after ``rounds`` assignments, from the given centres.

    ``points`` is ``(id, features array)``.  A round is one pass with a partial
    mean per task; ``k`` centres come back to the driver, and a cluster that
    lost all its points keeps its centre.
    """
    current = np.asarray(centres, dtype=np.float64)
    base = points.where("features is not null").select("id", "features")
    for _ in range(rounds - 1):
        assigned = base.select(
            _nearest(current)("features").alias("cluster"),
            array_to_vector(F.col("features").cast("array<double>")).alias("vector"),
        )
        means = assigned.groupBy("cluster").agg(Summarizer.mean(F.col("vector")).alias("mean"))
        moved = current.copy()
        for row in means.collect():  # at most k rows
            moved[row["cluster"]] = row["mean"].toArray()
        current = moved
    return base.select("id", _nearest(current)("features").alias("cluster"))


def vector_rows(points: DataFrame, col: str = "features") -> DataFrame:
    """A vector column as ``(page_id, dim, value)`` rows."""
    return points.select("page_id", F.posexplode(vector_to_array(col)).alias("dim", "value"))


def to_vectors(points: DataFrame, col: str) -> DataFrame:
    """``(page_id, features)`` from an array column."""
    return points.select(
        "page_id", array_to_vector(F.col(col).cast("array<double>")).alias("features")
    )


def active_rows(points: DataFrame) -> DataFrame:
    """The active entries of sparse vectors: ``(page_id, bucket, weight)`` rows.

    Indices and values are read as they are stored; nothing becomes dense.
    """
    stored = F.unwrap_udt("features")
    return points.select("page_id", stored.alias("stored")).select(
        "page_id", F.inline(F.arrays_zip("stored.indices", "stored.values"))
    ).toDF("page_id", "bucket", "weight")

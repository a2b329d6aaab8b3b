"""Materialising intermediate results so that they outlive lost executors.

Two ways are used, both on the shared folder that the cluster names in
``spark.checkpoint.dir``:

* :func:`stage` writes a Parquet table.  It is the form for anything read more
  than once: later steps read only the columns they need, and the planner sees
  the true size, so that it broadcasts a side only when that side is known to
  be small and otherwise shuffles it in a form AQE can split when it is skewed.
* :func:`cut` is a reliable ``checkpoint()`` for the state of a loop.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: For local sessions that name no folder.
LOCAL_FOLDER = f"{tempfile.gettempdir()}/pageloom"
_TABLES: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; in local mode a fixed one if none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return LOCAL_FOLDER


def scratch_root(spark: SparkSession) -> str:
    """The folder that holds everything this application stages."""
    return f"{shared_folder(spark)}/pageloom-{spark.sparkContext.applicationId}"


_CLEANING: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for one staged table or text directory."""
    app = spark.sparkContext.applicationId
    if app not in _CLEANING:
        _CLEANING.add(app)
        atexit.register(drop_staged, spark)
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stage` that nothing reads any more."""
    jsc = df.sparkSession.sparkContext._jsc
    root = scratch_root(df.sparkSession).split(":")[-1]
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if root in folder:  # never touch an input
            path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def stage_bucketed(df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    """Like :func:`stage`, but laid out for repeated joins on ``keys``.

    A join on ``keys`` reads the ``buckets`` in place and shuffles only its other
    side.  A bucket is one task, so their number has to follow the table's size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = "pageloom_" + path.rsplit("-", 1)[-1]
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(table)
    return spark.table(table)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the returned frame has no lineage behind it."""
    sc = df.sparkSession.sparkContext
    root = scratch_root(df.sparkSession)
    if root not in (sc.getCheckpointDir() or ""):
        sc.setCheckpointDir(f"{root}/checkpoints")  # deleted with all that is staged
    return df.checkpoint(eager=True)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged (also done when the driver ends)."""
    jsc = spark.sparkContext._jsc
    if jsc is None:
        return
    try:
        for table in _TABLES.pop(spark.sparkContext.applicationId, []):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may be gone already
        pass

"""Output of micro-batches that readers see whole or not at all.

A batch writes its tables to folders of their own and is then listed: a small file with
the folders' names is written aside and renamed into ``_commits``, which is one atomic
step of the file system.  Readers take listed folders only, so a batch that failed half
way, or one that is being written, shows nothing, and all tables of a batch appear
together.  A batch that was listed before is not done again, so restarts add nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

COMMITS = "_commits"


class BatchLog:
    """The committed batches below one folder."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.out).getFileSystem(conf)

    def _commit_path(self, batch_id: int):
        return self._path(f"{self.out}/{COMMITS}/{batch_id}")

    def committed(self, batch_id: int) -> bool:
        return self._files.exists(self._commit_path(batch_id))

    def commit(self, batch_id: int, **tables: DataFrame) -> bool:
        """Write the tables and list them; False if the batch was listed before."""
        if self.committed(batch_id):
            return False
        attempt = uuid.uuid4().hex
        folders = []
        for name, table in tables.items():
            folder = f"{name}/batch_id={batch_id}/attempt=a{attempt}"
            table.write.parquet(f"{self.out}/{folder}")
            folders.append(folder)
        aside = self._path(f"{self.out}/{COMMITS}/.{batch_id}-{attempt}")
        stream = self._files.create(aside)
        stream.write(bytearray("\n".join(folders).encode()))
        stream.close()
        if self.committed(batch_id) or not self._files.rename(aside, self._commit_path(batch_id)):
            self._files.delete(aside, False)
            return False
        return True

    def folders(self, name: str) -> list[str]:
        """The listed folders of one table, by batch."""
        commits = self._path(f"{self.out}/{COMMITS}")
        if not self._files.exists(commits):
            return []
        listed = [s.getPath().getName() for s in self._files.listStatus(commits)]
        done = sorted(int(x) for x in listed if x.isdigit())
        lines = (x for b in done for x in self._lines(b))
        return [f"{self.out}/{x}" for x in lines if x.split("/", 1)[0] == name]

    def _lines(self, batch_id: int) -> list[str]:
        stream = self._files.open(self._commit_path(batch_id))
        try:
            return bytes(stream.readAllBytes()).decode().split("\n")
        finally:
            stream.close()

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """All committed rows of one table, with ``batch_id``; needs a schema if there is none."""
        folders = self.folders(name)
        rows = self.spark.read.option("basePath", f"{self.out}/{name}")
        if schema is None:
            return rows.parquet(*folders).drop("attempt")
        wide = StructType([*schema.fields, StructField("batch_id", LongType())])
        if not folders:
            return self.spark.createDataFrame([], wide)
        return rows.schema(wide).parquet(*folders).select(*wide.names)

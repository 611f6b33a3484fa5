"""Session helpers: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; a cluster
    session without it is an error, since a machine-local folder is not visible to all executors.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_scratch.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="proclivity-")
    )


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write the frame as Parquet in the shared folder and return a scan of what was written.

    Later jobs start from the files: the lineage is cut, lost executors cost nothing but a
    re-read, and each reader prunes columns and pushes its filters down.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rolling:
    """A table that is replaced again and again: a version's files are deleted once the next one is written."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self._root = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
        self._count = 0

    def write(self, df: DataFrame) -> DataFrame:
        self._count += 1
        path = f"{self._root}/{self._count}"
        df.write.parquet(path)
        self._delete(f"{self._root}/{self._count - 1}")
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        self._delete(self._root)

    def _delete(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def written(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``materialize`` for the length of a block: the files are deleted at its end, also after an error.

    Only what is read inside the block may depend on the table.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

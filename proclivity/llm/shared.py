"""Tables in the shared scratch folder, and a few column helpers used by several operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proclivity.session import scratch_dir


class Workspace:
    """Intermediate tables of one operator call, below the folder in ``spark.checkpoint.dir``.

    ``write`` cuts the lineage: later jobs read files every executor can see, so a lost executor costs a
    re-read. ``drop`` deletes a table that no later plan reads; what a returned frame reads must stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def write(self, df: DataFrame, label: str) -> DataFrame:
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{label}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._workspace_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._workspace_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(taken: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``taken`` has it (letter case does not tell columns apart)."""
    used, found = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        found.append(name)
    return found


def text_or_empty(name: str = "text") -> Column:
    """A null text counts as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once; a plain expression inside a lambda is worked out per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def binary_search(bounds: Column, steps: int, value: Column) -> Column:
    """How many of the first ``2**steps - 1`` ascending entries of ``bounds`` are at most ``value``."""
    return F.aggregate(
        F.array(*[F.lit(1 << s) for s in reversed(range(steps))]),
        F.lit(0),
        lambda low, step: F.when(F.get(bounds, low + step - 1) <= value, low + step).otherwise(low),
    )

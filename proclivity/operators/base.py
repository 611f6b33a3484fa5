"""Common base of the fitted steps: Spark ML estimators and models that can be stored and loaded."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession


class FittedStep(Model, MLWritable, MLReadable):
    """A fitted step: ``state`` holds a few numbers or names per column.

    ``parts`` names the attributes that hold more than that: further fitted steps, Spark ML models or tables, or lists
    of these. ``save(path)`` writes state and parts, ``load(path)`` reads them in any application that sees the path;
    a Spark ML ``PipelineModel`` of such steps is stored and loaded like any other.
    """

    parts: tuple[str, ...] = ()

    def __init__(self, state: dict | None = None):
        super().__init__()
        self.state = state or {}

    def write(self) -> StepWriter:
        return StepWriter(self)

    @classmethod
    def read(cls) -> StepReader:
        return StepReader(cls)

    def save_state(self, spark: SparkSession, path: str) -> None:
        """Write the state as a one-row JSON table."""
        spark.createDataFrame([(json.dumps(self.state),)], "state string").write.mode(
            "overwrite"
        ).json(path)

    @classmethod
    def load_state(cls, spark: SparkSession, path: str):
        """Read a step written by ``save_state``."""
        return cls(json.loads(spark.read.schema("state string").json(path).first()["state"]))


def _plain(value):
    """The value if JSON gives it back unchanged (but for tuples, which become lists); else an error."""
    if isinstance(value, dict):
        if not all(isinstance(k, str) for k in value):
            raise TypeError("names in a stored state must be text")
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    raise TypeError(f"{type(value).__name__} cannot be part of a stored state")


class StepWriter(MLWriter):
    """Writes a step's metadata and each of its parts below one folder."""

    def __init__(self, step: FittedStep):
        super().__init__()
        self.step = step

    def saveImpl(self, path: str) -> None:
        kinds = {name: self._store(getattr(self.step, name), f"{path}/parts/{name}") for name in self.step.parts}
        extra = {"state": _plain(self.step.state), "parts": kinds}
        DefaultParamsWriter.saveMetadata(self.step, path, self.sparkSession, extraMetadata=extra)

    def _store(self, part, path: str):
        """Stores a part and tells what it is: ``None``, "table", "step", or a list of these."""
        if part is None:
            return None
        if isinstance(part, (list, tuple)):
            return [self._store(p, f"{path}/{i}") for i, p in enumerate(part)]
        if isinstance(part, DataFrame):
            part.write.parquet(path)
            return "table"
        part.write().save(path)
        return "step"


class StepReader(MLReader):
    """Reads what ``StepWriter`` wrote."""

    def __init__(self, cls: type[FittedStep]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FittedStep:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark, f"{self.cls.__module__}.{self.cls.__name__}")

        def part(kind, at: str):
            if kind is None:
                return None
            if isinstance(kind, list):
                return [part(k, f"{at}/{i}") for i, k in enumerate(kind)]
            return spark.read.parquet(at) if kind == "table" else DefaultParamsReader.loadParamsInstance(at, spark)

        step = self.cls.__new__(self.cls)
        FittedStep.__init__(step, metadata["state"])
        step._resetUid(metadata["uid"])
        for name, kind in metadata["parts"].items():
            setattr(step, name, part(kind, f"{path}/parts/{name}"))
        return step


class Step(Estimator):
    """An unfitted step; ``fit_transform`` mirrors the usual one-frame use."""

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

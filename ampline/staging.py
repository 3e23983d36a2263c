"""Written intermediate tables: one evaluation for several readers, and a short lineage.

The tables of a run lie in one folder that its ``Staging`` owns and removes on ``close``. Tables that are written outside
any run lie in a folder of the application. What is not closed is removed when the application ends.
"""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_runs: ContextVar[tuple[Staging, ...]] = ContextVar("runs", default=())


def stage_root(spark: SparkSession) -> str:
    """The folder that the cluster names; only in local mode one of this application where it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{tempfile.gettempdir()}/ampline-{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


class Staging:
    """A folder for the tables of one run. Inside ``with`` all tables go there."""

    def __init__(self, spark: SparkSession, name: str | None = None):
        self.spark = spark
        self.folder = f"{stage_root(spark)}/ampline/{name or f'run-{uuid.uuid4().hex}'}"
        self._made = False

    def path(self, label: str) -> str:
        """A new place in the folder, which is made when first asked for."""
        if not self._made:
            files, folder = _file_system(self.spark, self.folder)
            files.mkdirs(folder)
            files.deleteOnExit(folder)
            self._made = True
        return f"{self.folder}/{label}-{uuid.uuid4().hex}"

    def close(self) -> None:
        """Remove the folder; tables in it can't be read any more."""
        if self._made:
            files, folder = _file_system(self.spark, self.folder)
            files.delete(folder, True)
            files.cancelDeleteOnExit(folder)
            self._made = False

    def __enter__(self) -> Staging:
        _runs.set((*_runs.get(), self))
        return self

    def __exit__(self, *_) -> None:
        _runs.set(_runs.get()[:-1])


_applications: dict[str, Staging] = {}


def new_path(spark: SparkSession, label: str) -> str:
    """A new place in the folder of the run at hand, or of the application."""
    if runs := _runs.get():
        return runs[-1].path(label)
    key = f"{spark.sparkContext.applicationId} {stage_root(spark)}"
    if key not in _applications:
        _applications[key] = Staging(spark, f"app-{spark.sparkContext.applicationId}")
    return _applications[key].path(label)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return a reader of the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, label: str, figures: dict[str, str]) -> tuple[DataFrame, dict]:
    """``stage``, and the ``figures`` (SQL aggregates by name) of all rows.

    The figures are taken while the rows are written, in the tasks that write them, so no further pass reads the rows.
    """
    watch = Observation(label)
    table = stage(df.observe(watch, *[F.expr(value).alias(name) for name, value in figures.items()]), label)
    return table, watch.get


def measured(df: DataFrame, label: str, figures: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """``counted``, with the figures as a table of one row."""
    schema = df.selectExpr(*[f"{value} as {name}" for name, value in figures.items()]).schema
    table, found = counted(df, label, figures)
    return table, df.sparkSession.createDataFrame([[found[name] for name in figures]], schema)

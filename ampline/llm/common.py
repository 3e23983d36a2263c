"""Helpers that the document operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ARROW_ROWS = 2500       # rows of a batch between the JVM and Python, at most, as texts are long
SLICE_BYTES = 6 << 20   # text bytes that a Python worker handles at a time; one longer text is a slice of its own

_shipped: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_fields(df: DataFrame, outputs: str) -> T.StructType:
    """The schema of ``df`` followed by ``outputs``, in DDL."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(outputs).fields])


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application, and keep the session's batches small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="ampline-py-")) / f"ampline-{context.applicationId}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what is run inside; for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``most`` bytes of text, but at least one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset + 1 : texts.offset + len(texts) + 1].astype(np.int64)
        ends -= np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]
        start = 0
        while start < batch.num_rows:
            done = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes start, start + 1, ... of each piece, one piece after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 30 and (not len(starts) or starts.max() < 1 << 30) else np.int64
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def string_column(texts: pa.Array) -> pa.Array:
    """The texts with empty ones for nulls."""
    return texts.fill_null("").cast(pa.string())

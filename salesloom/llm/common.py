"""Helpers that several operators of this folder share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.session import configure, shared_dir

# Rows of a batch that goes to Python at once. A batch of the longest usual texts
# (120 kB) then stays near 60 MB.
BATCH_ROWS = 512


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_salesloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="salesloom-code-")) / "salesloom_code.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    context._salesloom_shipped = True


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that these operators rely on, and their code on every executor."""
    configure(spark)
    shipped(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, name: str, **options) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: lost executors cost no earlier stage."""
    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def id_remainder(column: str, parts: int) -> Column:
    """crc32 of an id written as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def whole(column: str = "text") -> Column:
    """A text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lengths[i]] for all i, one after another."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    within = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    return values[np.repeat(starts, lengths) + within]


def chunks_by_size(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes sum up to about `most`; every slice holds one item at least."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))

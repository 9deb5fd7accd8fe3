"""Small files on the cluster's storage: listing, and switching a file in one rename.

Hadoop's own file classes, so that every storage that Spark reads works, with the credentials that the session has.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(Exception):
    """Somebody else wrote the file first."""


def _place(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if the folder is missing."""
    place, system = _place(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    place, system = _place(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a file in one step: readers see all of it or nothing. Raises AlreadyThere if it exists."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    place, system = _place(spark, draft)
    stream = system.create(place, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    none = spark.sparkContext._gateway.new_array(rename, 1)
    none[0] = rename.NONE
    target = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(place, target, none)
    except Py4JJavaError as error:
        system.delete(place, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise AlreadyThere(path) from None
        raise


def delete(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)

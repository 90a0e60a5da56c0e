"""The few calls on the shared file system that Spark's readers and writers do not offer.

They go through Hadoop, so any store that Spark writes to will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession


class AlreadyThere(FileExistsError):
    """Another writer made the file first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of what lies in ``folder``; none if there is no such folder."""
    files, where = _files(spark, folder), _path(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def create_once(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Make a file whole or not at all; AlreadyThere if one of that name exists."""
    aside = f"{folder}/_{uuid.uuid4().hex}"
    out = _files(spark, folder).create(_path(spark, aside), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename_once(spark, aside, f"{folder}/{name}")


def rename_once(spark: SparkSession, aside: str, path: str) -> None:
    """Give a finished file or folder its name, which HDFS and object-store connectors for it do in one step.

    If there is one of that name already, the one aside is removed, and AlreadyThere says so.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    source, target = _path(spark, aside), _path(spark, path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target.getParent())
    kinds = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    try:
        fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration()).rename(source, target, options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        remove(spark, aside)
        raise AlreadyThere(path) from None


def measured(seen: Observation, again: Callable[[], dict]) -> dict:
    """What ``seen`` observed while rows were written. Where Spark found the input empty it drops the observation; ``again`` tells it then."""
    try:
        return seen.get
    except Py4JJavaError:
        return again()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where there is none."""
    _files(spark, path).delete(_path(spark, path), True)

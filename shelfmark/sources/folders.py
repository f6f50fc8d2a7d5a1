"""Names in Spark's file systems: the few steps that its readers and writers do not offer.

Only names and short notes pass through here; rows are read and written by Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    """The file system a path is in, and the path there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _resolve(spark, path)
    return system.exists(place)


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, length) of what matches a pattern, in the order of their paths."""
    system, place = _resolve(spark, pattern)
    return sorted((s.getPath().toString(), s.getLen()) for s in system.globStatus(place) or [])


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; what stands at ``target`` is replaced."""
    system, old = _resolve(spark, source)
    _, new = _resolve(spark, target)
    if system.exists(new):
        system.delete(new, True)
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"{source} could not be renamed to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder, if it is there."""
    system, place = _resolve(spark, path)
    system.delete(place, True)


def read_note(spark: SparkSession, path: str) -> str | None:
    """A short text file, or None if there is none."""
    system, place = _resolve(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Writes a short text file under another name and renames it, so that no one reads a part of it."""
    hidden = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    system, place = _resolve(spark, hidden)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, hidden, path)

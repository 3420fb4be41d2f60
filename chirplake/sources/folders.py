"""Folders on whatever file system their path names."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and without what does not matter."""
    system, place = _at(spark, path)
    return system.makeQualified(place).toString()


def list_folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Folders directly in a folder, each with the seconds since its last change; none if it is not there."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    found = [status for status in system.listStatus(place) if status.isDirectory()]
    now = time.time()
    return [(f.getPath().toString(), now - f.getModificationTime() / 1000) for f in found]


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all in it; False if it was not there."""
    system, place = _at(spark, path)
    return system.delete(place, True)


def move_file(spark: SparkSession, path: str, folder: str) -> bool:
    """Move a file below a folder, under all of its old path; False if it is gone already."""
    system, place = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}{place.toUri().getPath()}")
    if not system.exists(place):
        return False
    system.mkdirs(target.getParent())
    if system.exists(target):
        raise FileExistsError(f"{target.toString()} is there already")
    return system.rename(place, target)


def touch_file(spark: SparkSession, path: str) -> None:
    """Set a file's time of change to now."""
    system, place = _at(spark, path)
    system.setTimes(place, int(time.time() * 1000), -1)

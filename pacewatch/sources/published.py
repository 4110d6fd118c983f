"""Versions of a table behind one pointer.

Every publication is a folder of its own that is never changed. A small file names the
version in force and the one before; it is written aside and renamed over the old one, so a
reader sees the one or the other, and a crash at any point leaves the old version in force.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "current"


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()


def pointer(spark: SparkSession, path: str) -> dict | None:
    """What the pointer under ``path`` says: the version in force and the one before it."""
    hadoop, settings = _hadoop(spark)
    where = hadoop.Path(f"{path}/{POINTER}")
    if not where.getFileSystem(settings).exists(where):
        return None
    return json.loads(spark.read.text(where.toString(), wholetext=True).first().value)


def point(spark: SparkSession, path: str, version: str) -> None:
    """Put a version in force, by one rename over the old pointer.

    The rename is atomic where the file system's is. Two publishers at a time leave the pointer
    of one of them, whole.
    """
    before = pointer(spark, path)
    said = {"version": version, "previous": before["version"] if before else None}
    hadoop, settings = _hadoop(spark)
    aside = hadoop.Path(f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    out = aside.getFileSystem(settings).create(aside, True)
    try:
        out.write(bytearray(json.dumps(said).encode()))
    finally:
        out.close()
    rename = getattr(hadoop, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    target = hadoop.Path(f"{path}/{POINTER}")
    hadoop.FileContext.getFileContext(target.toUri(), settings).rename(aside, target, over)


def roll_back(spark: SparkSession, path: str) -> str:
    """Put the version before in force again; a second call returns to the later one."""
    said = pointer(spark, path)
    if said is None or said["previous"] is None:
        raise ValueError(f"{path}: no earlier version to return to")
    point(spark, path, said["previous"])
    return said["previous"]


def new_version(path: str) -> str:
    """A folder for a version that is to be written."""
    return f"{path}/versions/{uuid.uuid4().hex}"


def read_current(spark: SparkSession, path: str, part: str = "") -> DataFrame:
    """The table, or a part of it by name, of the version in force."""
    said = pointer(spark, path)
    if said is None:
        raise ValueError(f"{path}: nothing is published")
    return spark.read.parquet(f"{said['version']}/{part}".rstrip("/"))

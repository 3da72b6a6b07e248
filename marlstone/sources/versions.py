"""Folders that are replaced whole: every version is written beside the others, and one pointer file names
the one that holds. Moving the pointer is a single atomic rename, so a reader finds a whole version at any time
and a writer that dies leaves the former one in place.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER, PREFIX = "_CURRENT", "v-"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, folder: str) -> str | None:
    """The version that holds; the path itself if it was never published to, None if nothing is there.

    Files that stood in a folder before its first version stay, and are not part of any version.
    """
    fs, path, pointer = _files(spark, folder), _path(spark, folder), _path(spark, folder, POINTER)
    if not fs.exists(path):
        return None
    if not fs.getFileStatus(path).isDirectory() or not fs.exists(pointer):
        return folder
    stream = fs.open(pointer)
    try:
        name = stream.readUTF()
    finally:
        stream.close()
    return f"{folder}/{name}"


def write_version(spark: SparkSession, folder: str, write: Callable[[str], None]) -> str:
    """Write a version, which no reader sees yet; its name. ``write`` gets the folder to fill."""
    name = f"{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(f"{folder}/{name}")
    return name


def point_to(spark: SparkSession, folder: str, name: str) -> None:
    """Let ``name`` be the version that holds, by one atomic rename over the pointer."""
    fs, fresh = _files(spark, folder), _path(spark, folder, f"{POINTER}.{uuid.uuid4().hex}")
    stream = fs.create(fresh, False)
    stream.writeUTF(name)
    stream.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(fresh), fs.makeQualified(_path(spark, folder, POINTER)), options)


def drop_old(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` versions, the one that holds aside. Readers of a deleted one fail."""
    fs, held = _files(spark, folder), current(spark, folder).rsplit("/", 1)[-1]
    names = sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, folder)) if s.getPath().getName().startswith(PREFIX))
    for name in names[: max(0, len(names) - keep)]:
        if name != held:
            fs.delete(_path(spark, folder, name), True)


def publish(spark: SparkSession, folder: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Write a version, let it hold, and delete old ones; the path of the version."""
    name = write_version(spark, folder, write)
    point_to(spark, folder, name)
    drop_old(spark, folder, keep)
    return f"{folder}/{name}"

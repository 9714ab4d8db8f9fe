"""Versions of an archive in one folder: a reader sees one whole version, also while another is written.

`_data/<folder>` holds the tables of a version. `_versions/<number>` is a small file that names its folder; the highest number
with a whole name counts. A version begins with the creation of its file, which fails if the number is taken: nothing is renamed
or replaced, so it holds on object stores too (as far as the store refuses to create a file twice; of two processes on
one machine's disk it does not always).
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from sediment.errors import ChangedOutput
from sediment.staging import filesystem

VERSIONS, DATA = "_versions", "_data"
# Versions whose tables stay: the newest one, and the one that readers who began before it may still read.
KEPT = 2


def _store(spark: SparkSession, path: str):
    """File system and path. Local files go without the check sums beside them, as two files cannot appear at once."""
    fs, hadoop_path = filesystem(spark, path)
    return (fs.getRawFileSystem() if fs.getScheme() == "file" else fs), hadoop_path


def _name(out: str, number: int) -> str:
    return f"{out}/{VERSIONS}/{number:012d}"


def numbers(spark: SparkSession, out: str) -> list[int]:
    """Numbers given so far, whole or not; none for a folder without versions."""
    fs, path = _store(spark, f"{out}/{VERSIONS}")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path) if s.isFile()) if fs.exists(path) else []


def folder_of(spark: SparkSession, out: str, number: int) -> str | None:
    """The folder of a version; None if its file is not whole yet, or gone again."""
    fs, path = _store(spark, _name(out, number))
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{out}/{DATA}/{text[:-1]}" if text.endswith("\n") else None


def current(spark: SparkSession, out: str) -> str:
    """Where the tables lie: the folder of the newest whole version, or `out` itself if it has none."""
    found = (folder_of(spark, out, n) for n in reversed(numbers(spark, out)))
    return next((folder for folder in found if folder), out)


def commit(spark: SparkSession, out: str, number: int, folder: str) -> None:
    """Makes `folder` the version `number`. Stops if another run took the number."""
    fs, path = _store(spark, _name(out, number))
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise ChangedOutput(f"another run published to {out} meanwhile") from error
        raise
    stream.write(f"{folder}\n".encode())
    stream.close()


def prune(spark: SparkSession, out: str, kept: int = KEPT) -> None:
    """Deletes versions older than the newest `kept`, and tables beside them that are of none."""
    fs, root = filesystem(spark, out)
    for number in numbers(spark, out)[:-kept]:
        if folder := folder_of(spark, out, number):
            fs.delete(filesystem(spark, folder)[1], True)
        fs.delete(filesystem(spark, _name(out, number))[1], False)
    for status in fs.listStatus(root):
        if status.getPath().getName() not in (VERSIONS, DATA):
            fs.delete(status.getPath(), True)

"""Tables a job writes for its own use, in the folder the cluster names for checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Makes Spark drop what a query shuffled when the query ends, instead of when the driver happens to collect garbage.
DROP_SHUFFLED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    It is what the session names. Only a local session without one gets a folder of its own: on a
    cluster a folder of the driver's machine would be out of the executors' reach.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getConf().get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="sediment-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def filesystem(spark: SparkSession, path: str):
    """Hadoop file system and path object for `path`."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


# The folders that the innermost open `discarding` block of this thread gathers.
_OPEN: ContextVar[list["Staging"] | None] = ContextVar("open", default=None)


@contextmanager
def discarding() -> Iterator[None]:
    """Drops at its end the folders this thread made within, so what is read afterwards has to be written elsewhere by then."""
    made: list[Staging] = []
    token = _OPEN.set(made)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for staging in made:
            staging.drop()


# Writes under way, and what the session had for DROP_SHUFFLED before the first of them, by session.
_WRITES: dict[str, tuple[int, str | None]] = {}
_LOCK = Lock()


@contextmanager
def dropping_shuffled(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries within go when these end. A table that is written is read from its files, so only a query that is still running needs them;
    the session's own setting comes back when no thread is within."""
    session = spark._jsparkSession.sessionUUID()
    with _LOCK:
        n, before = _WRITES.get(session) or (0, spark.conf.get(DROP_SHUFFLED, None))
        spark.conf.set(DROP_SHUFFLED, "true")
        _WRITES[session] = n + 1, before
    try:
        yield
    finally:
        with _LOCK:
            n, before = _WRITES.pop(session)
            if n > 1:
                _WRITES[session] = n - 1, before
            elif before is None:
                spark.conf.unset(DROP_SHUFFLED)
            else:
                spark.conf.set(DROP_SHUFFLED, before)


class Staging:
    """One run's folder. Each table is written once and read back as a plain scan."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or checkpoint_root(spark)}/sediment-{uuid4().hex}"
        if (made := _OPEN.get()) is not None:
            made.append(self)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        with dropping_shuffled(self.spark):
            df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes the named tables, as far as they are there, or all."""
        for at in [f"{self.root}/{n}" for n in names] or [self.root]:
            fs, path = filesystem(self.spark, at)
            fs.delete(path, True)

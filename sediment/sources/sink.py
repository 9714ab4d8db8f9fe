"""Publish a set of tables as one folder."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from sediment.errors import UnsafeOutput
from sediment.sources import versions
from sediment.sources.archive import CONSTRAINT_ROWS, CONSTRAINTS, Constraints
from sediment.staging import filesystem


def _qualified(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = filesystem(spark, path)
    return fs.makeQualified(hadoop_path).toUri().getPath().rstrip("/")


def check_output(spark: SparkSession, out: str, inputs: Sequence[str]) -> None:
    """Stop if `out` is an input, lies in one, or holds one."""
    target = _qualified(spark, out)
    for source in inputs:
        known = _qualified(spark, source)
        if known == target or known.startswith(f"{target}/") or target.startswith(f"{known}/"):
            raise UnsafeOutput(f"output {out} overlaps input {source}")


class Publisher:
    """Tables are written aside and published once all are there.

    A plain output is one folder, which replaces the earlier one by two renames. With `versioned`, or where `out` has versions
    already, the tables stay where they were written and a pointer to them is added: readers see the earlier archive or this one.
    """

    def __init__(self, spark: SparkSession, out: str, versioned: bool = False):
        self.spark = spark
        self.out = out.rstrip("/")
        taken = versions.numbers(spark, self.out)
        self.number = max(taken, default=0) + 1 if versioned or taken else None
        name = uuid4().hex
        self.pending = f"{self.out}.pending-{name}" if self.number is None else f"{self.out}/{versions.DATA}/{name}"
        # Where the tables lie once published.
        self.home = self.out if self.number is None else self.pending

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a table and returns a scan of it, good until it is published."""
        path = f"{self.pending}/{name}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def declare(self, constraints: Mapping[str, Constraints]) -> None:
        """Writes down what each table keeps to, so that the archive can be merged onto."""
        rows = [(table, declared.to_json()) for table, declared in constraints.items()]
        self.write(CONSTRAINTS, self.spark.createDataFrame(rows, CONSTRAINT_ROWS).coalesce(1))

    def __enter__(self) -> "Publisher":
        return self

    def __exit__(self, error, *_) -> None:
        """A run that fails leaves nothing behind."""
        if error is not None:
            fs, pending = filesystem(self.spark, self.pending)
            fs.delete(pending, True)

    def publish(self) -> None:
        if self.number is None:
            self._replace()
        else:
            versions.commit(self.spark, self.out, self.number, self.pending.rsplit("/", 1)[1])
            versions.prune(self.spark, self.out)

    def _replace(self) -> None:
        fs, target = filesystem(self.spark, self.out)
        _, pending = filesystem(self.spark, self.pending)
        if not fs.exists(target):
            fs.mkdirs(target.getParent())
            moved = fs.rename(pending, target)
        else:
            _, previous = filesystem(self.spark, f"{self.pending}.previous")
            moved = fs.rename(target, previous) and fs.rename(pending, target)
            if moved:
                fs.delete(previous, True)
        if not moved:
            raise OSError(f"could not publish {self.pending} as {self.out}")


"""Order of snapshots by their newest message."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.errors import InvalidSnapshot
from sediment.functions.expressions import long_array
from sediment.specs import RANK, SNAPSHOT, TIME


@dataclass(frozen=True)
class RankedSnapshot:
    snapshot_id: int
    path: str
    max_ts: int
    merge_rank: int
    is_base: bool


def newest_times(messages: DataFrame) -> DataFrame:
    """Newest message time of every snapshot, in one pass over all of them."""
    return messages.groupBy(SNAPSHOT).agg(F.max(TIME).alias("max_ts"))


def checked_times(snapshots: DataFrame, messages: DataFrame) -> DataFrame:
    """Every snapshot with its newest time and whether the time is usable (present, not negative)."""
    times = snapshots.join(newest_times(messages), SNAPSHOT, "left")
    valid = F.col("max_ts").isNotNull() & (F.col("max_ts") >= 0)
    return times.withColumn("is_valid", F.when(valid, 1).otherwise(0))


def ranking(times: DataFrame) -> DataFrame:
    """Merge order and base from (snapshot_id, path, max_ts), one row per snapshot.

    Newest first, ties by path. The base is the newest too, but a tie goes to the snapshot given first,
    and a time of 0 cannot be the base.
    """
    by_rank = Window.orderBy(F.desc("max_ts"), F.asc("path"))
    by_argument = Window.orderBy(F.desc("max_ts"), F.asc(SNAPSHOT))
    first = F.row_number().over(by_argument) == 1
    return times.select(
        "*",
        F.row_number().over(by_rank).alias(RANK),
        F.when(first & (F.col("max_ts") > 0), 1).otherwise(0).alias("is_base"),
    )


def snapshot_list(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(snapshot_id, path) of the snapshots in the order given."""
    ids = spark.range(len(paths)).select(F.col("id").cast("int").alias(SNAPSHOT))
    return ids.select(SNAPSHOT, F.array(*(F.lit(p) for p in paths))[F.col(SNAPSHOT)].alias("path"))


def rank_snapshots(spark: SparkSession, paths: Sequence[str], messages: DataFrame) -> list[RankedSnapshot]:
    """Validated snapshots in merge order. Stops on a snapshot without a usable newest time."""
    rows = ranking(checked_times(snapshot_list(spark, paths), messages)).collect()
    bad = sorted(r["path"] for r in rows if not r["is_valid"])
    if bad:
        raise InvalidSnapshot(f"no usable message time in: {', '.join(bad)}")
    if not any(r["is_base"] for r in rows):
        raise InvalidSnapshot("no snapshot has a message time above 0")
    ordered = sorted(rows, key=lambda r: r[RANK])
    return [RankedSnapshot(r[SNAPSHOT], r["path"], r["max_ts"], r[RANK], bool(r["is_base"])) for r in ordered]


def rank_column(ranked: Sequence[RankedSnapshot]) -> Column:
    """merge_rank of the row's snapshot."""
    by_id = {r.snapshot_id: r.merge_rank for r in ranked}
    ranks = long_array([by_id.get(i, 0) for i in range(max(by_id) + 1)])
    return ranks[F.col(SNAPSHOT)].cast("int")

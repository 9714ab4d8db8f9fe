"""Joins that fetch columns of one matching row from another table.

A table proven small is broadcast. Any other is joined by shuffle, and keys with more left rows than one
task should have are spread over as many tasks as their rows need.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.expressions import any_null, long_array

# A table of at most this many bytes may be sent to every executor.
BROADCAST_BYTES = 32 << 20
# Left rows of one key that one task may join; a key with more is split.
TASK_ROWS = 1_000_000
# Keys the frequency sketch tracks. It misses no key with more than about one in TRACKED_KEYS of all rows, so one
# task gets at most TASK_ROWS rows of a key or that share, whichever is more. 16 bytes each on the driver.
TRACKED_KEYS = 1 << 16
# Slots rows are counted by before any sketch is made: a power of two.
SLOTS = 1 << 14
# Left rows without a key match nothing; they are spread over so many tasks.
NULL_SPREAD = 1024


@dataclass(frozen=True)
class Sized:
    """A table with its counted rows and measured bytes."""

    df: DataFrame
    rows: int
    bytes: int

    @classmethod
    def of(cls, df: DataFrame, rows: int | None = None) -> "Sized":
        """Measures `df`: 8 bytes a value, and the real length of texts and binaries.

        With known `rows` and only fixed-width columns nothing has to run. Texts of a table that is too
        large anyway are not measured.
        """
        fixed = 8 * max(len(df.columns), 1)
        varying = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
        binary = any(isinstance(f.dataType, T.BinaryType) for f in df.schema.fields)
        if rows is None and (binary or not varying):
            rows = df.count()
        if rows is not None and (not varying or rows * fixed > BROADCAST_BYTES):
            return cls(df, rows, rows * fixed if not varying else max(rows * fixed, BROADCAST_BYTES + 1))
        lengths = (F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in varying)
        total = reduce(lambda x, y: x + y, lengths)
        found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("b")).first()
        return cls(df, found["n"], found["n"] * fixed + found["b"])

    def fits(self, limit: int | None = None) -> bool:
        return self.bytes <= (BROADCAST_BYTES if limit is None else limit)


def lookup(
    left: DataFrame,
    right: Sized,
    on: dict[str, str],
    take: dict[str, str],
    how: str = "left",
    spread: Sequence[str] = (),
    limit: int | None = None,
    keys_from: DataFrame | None = None,
    hot: dict[int, int] | None = None,
) -> DataFrame:
    """`left` plus columns `take` (right name -> new name) of the right rows where `on` is equal.

    Null keys match nothing. A shuffled join sorts by the keys in the order of `on`, so the one with most values should be first. `spread` names left columns that tell rows of one key apart; it decides
    only which task joins a row. `keys_from` is a cheaper table with the same left keys, to find hot ones in;
    `hot` are those found already, by the keys in the order of `on`.
    """
    types = {f.name: f.dataType for f in left.schema.fields}
    keys = {f"_k{i}": (lk, rk) for i, (lk, rk) in enumerate(on.items())}
    small = right.df.select(
        *(F.col(rk).cast(types[lk]).alias(k) for k, (lk, rk) in keys.items()),
        *(F.col(r).alias(new) for r, new in take.items()),
    )
    condition = [left[lk] == F.col(k) for k, (lk, _) in keys.items()]
    if right.fits(limit):
        joined = left.join(F.broadcast(small), condition, how)
        return joined.drop(*keys)
    if hot is None:
        hot = hot_keys(left if keys_from is None else keys_from, list(on))
    return _salted(left, small, keys, hot, how, tuple(spread) or tuple(left.columns))


def hot_keys(df: DataFrame, keys: Sequence[str], task_rows: int | None = None) -> dict[int, int]:
    """Hash of every key with more than `task_rows` rows, and the number of tasks its rows need.

    Rows are counted by SLOTS slots of their keys' hashes. A hot key makes its slot crowded, so where no slot is there is nothing to
    look for; else one more pass looks at the keys of crowded slots. There each task keeps a sketch of frequent items; sketches are merged in two
    steps, so the number of tasks does not matter. Hashes and counts come to the driver, at most TRACKED_KEYS of them: both
    sides of a join must see the very same ones, and a second run of the sketches may differ at the margin.
    """
    task_rows = TASK_ROWS if task_rows is None else task_rows
    hashes = df.dropna(subset=list(keys)).select(F.xxhash64(*keys).alias("_h"))
    slot = F.pmod("_h", F.lit(SLOTS))
    counted = hashes.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    # At most SLOTS rows.
    crowded = [r["_slot"] for r in counted.where(F.col("_n") > task_rows).select("_slot").collect()]
    if not crowded:
        return {}
    if len(crowded) < SLOTS:
        words = [0] * (SLOTS >> 6)
        for x in crowded:
            words[x >> 6] |= 1 << (x & 63)
        bits = long_array([w - (w >> 63 << 64) for w in words])
        hashes = hashes.where(F.getbit(bits[F.shiftright(slot, 6).cast("int")], slot.bitwiseAND(63).cast("int")) == 1)
    group = F.pmod(F.spark_partition_id(), F.lit(256)).alias("_g")
    partial = hashes.groupBy(group).agg(F.expr(f"approx_top_k_accumulate(_h, {TRACKED_KEYS})").alias("_s"))
    # Grouped by a constant: without rows there is no group, where a plain aggregate would have no sketch to read.
    merged = partial.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(_s, {TRACKED_KEYS})").alias("_s"))
    top = merged.select(F.inline(F.expr(f"approx_top_k_estimate(_s, {TRACKED_KEYS})")))
    found = top.where(F.col("count") > task_rows).select("item", "count").collect()
    return {r["item"]: -(-r["count"] // task_rows) for r in found}


def _salted(
    left: DataFrame, small: DataFrame, keys: dict, hot: dict[int, int], how: str, spread: tuple[str, ...]
) -> DataFrame:
    left_keys = [lk for lk, _ in keys.values()]
    no_key = any_null(left_keys)
    # Without hot keys nothing is copied. Otherwise the list of them is at most TRACKED_KEYS rows of two numbers.
    parts = _parts(left.sparkSession, hot) if hot else None
    place = F.xxhash64(*spread)
    left_hash, right_hash = F.when(~no_key, F.xxhash64(*left_keys)), F.xxhash64(*keys)
    salt = F.when(no_key, F.pmod(place, F.lit(NULL_SPREAD)))
    if parts is None:
        salted = left.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int"))
        copied = small.withColumn("_rsalt", F.lit(0))
    else:
        tagged = left.withColumn("_hash", left_hash).join(F.broadcast(parts), "_hash", "left")
        salt = F.coalesce(salt, F.pmod(place, F.col("_parts")), F.lit(0)).cast("int")
        salted = tagged.withColumn("_salt", salt).drop("_hash", "_parts")
        copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
        copied = small.withColumn("_hash", right_hash).join(F.broadcast(parts), "_hash", "left")
        copied = copied.withColumn("_rsalt", F.explode(copies)).drop("_hash", "_parts")
    condition = [salted[lk] == copied[k] for k, (lk, _) in keys.items()]
    joined = salted.join(copied, [*condition, salted["_salt"] == copied["_rsalt"]], how)
    return joined.drop("_salt", "_rsalt", *keys)


def _parts(spark: SparkSession, hot: dict[int, int]) -> DataFrame:
    """`_hash`, `_parts` of the hot keys."""
    return spark.createDataFrame(list(hot.items()), "_hash long, _parts int")

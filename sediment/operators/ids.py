"""Dense ids in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.expressions import any_null, long_array
from sediment.staging import Staging

# monotonically_increasing_id keeps the partition number above this bit and the row's place below it.
_PLACE_BITS = 33


def assign_ordered_ids(
    df: DataFrame,
    order: Sequence[str],
    staging: Staging,
    name: str,
    id_column: str = "_id",
) -> tuple[DataFrame, int]:
    """`df` with ids 1..n that follow `order`, and n.

    The rows are range-partitioned and sorted on `order` and written once, each with its partition
    number and place. A second small pass counts the rows per partition; an id is the count of all
    earlier partitions plus the place. `order` should tell all rows apart: then the ranges are even
    even if most rows share one time, and a re-run task writes the same rows.
    """
    ranged = df.orderBy(*order).withColumn("_seq", F.monotonically_increasing_id())
    written = staging.write(name, ranged)
    partition = F.shiftright("_seq", _PLACE_BITS)
    place = F.col("_seq").bitwiseAND((1 << _PLACE_BITS) - 1)
    # One row per written partition, so the driver sees at most as many rows as there are shuffle partitions.
    counts = {r["p"]: r["n"] for r in written.groupBy(partition.alias("p")).agg((F.max(place) + 1).alias("n")).collect()}
    offsets, total = [], 0
    for p in range(max(counts, default=0) + 1):
        offsets.append(total)
        total += counts.get(p, 0)
    new_id = long_array(offsets)[partition.cast("int")] + place + 1
    return written.withColumn(id_column, new_id).drop("_seq"), total


def number_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    staging: Staging,
    name: str,
    number_column: str = "_rn",
) -> DataFrame:
    """Row numbers 1..n inside each group, with no group held by one task.

    One range sort, whose ranges may cut a large group anywhere. A task knows the place of each row and that of the first row of its
    group in the same range; what a group has in earlier ranges is worked out from one row per range.
    Rows with a null in the group columns are left out.
    """
    known = df.where(~any_null(group))
    schema = T.StructType([*known.schema.fields, *(T.StructField(c, T.LongType()) for c in ("_part", "_place", "_run"))])
    written = staging.write(name, known.orderBy(*group, *order).mapInArrow(_runs(list(group)), schema))
    key = F.struct(*group)
    ends = written.groupBy("_part").agg(
        (F.max("_place") + 1).alias("n"), F.max("_run").alias("run"), F.min_by(key, "_place").alias("first"), F.max_by(key, "_place").alias("last")
    )
    # At most as many rows as there are shuffle partitions, each with the keys at its ends.
    carried, before, at_end = [], None, 0
    for r in sorted(ends.collect(), key=lambda r: r["_part"]):
        carried += [0] * (r["_part"] - len(carried))
        carried.append(at_end if before is not None and all(map(_alike, before, r["first"])) else 0)
        at_end = r["n"] - r["run"] + (carried[-1] if r["run"] == 0 else 0)
        before = r["last"]
    earlier = F.when(F.col("_run") == 0, long_array(carried)[F.col("_part").cast("int")]).otherwise(0)
    number = F.col("_place") - F.col("_run") + 1 + earlier
    return written.withColumn(number_column, number).drop("_part", "_place", "_run")


def _alike(x, y) -> bool:
    """Equal, as Spark groups them: a number that is none is like another."""
    return x == y or (x != x and y != y)


def _runs(group: list[str]):
    """Adds to sorted rows the number of their task, their place in it and the place of the first row there with their key."""

    def run(batches):
        # Workers need not find the library, so all that is used comes from here.
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, place, start, last = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            new[0] = last is None
            for i, g in enumerate(group):
                keys = batch.column(g)
                if last is not None:
                    keys = pa.concat_arrays([last[i], keys])
                differs = pc.not_equal(keys[1:], keys[:-1])
                if pa.types.is_floating(keys.type):
                    differs = pc.and_not(differs, pc.and_(pc.is_nan(keys[1:]), pc.is_nan(keys[:-1])))
                new[n - len(differs) :] |= differs.to_numpy(zero_copy_only=False)
            # A copy, so that the whole batch need not stay.
            last = [pa.array([batch.column(g)[n - 1]], batch.column(g).type) for g in group]
            places = np.arange(place, place + n)
            runs = np.maximum.accumulate(np.where(new, places, start))
            place, start = place + n, int(runs[-1])
            columns = [*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(places), pa.array(runs)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_part", "_place", "_run"])

    return run

"""Old id to new id, per snapshot."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.functions.expressions import any_null
from sediment.operators.ids import number_within
from sediment.operators.lookup import Sized, lookup
from sediment.specs import NEW_ID, OLD_ID, RANK, SNAPSHOT
from sediment.staging import Staging


def strict_map(
    rows: DataFrame,
    survivors: DataFrame,
    rows_kept: int | None,
    key: Sequence[str],
    map_key: Sequence[str],
    casts: dict[str, str] | None = None,
    limit: int | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(snapshot_id, old_id, new_id): every row goes to the survivor of its full natural key.

    `rows` are all rows of all snapshots with foreign keys already remapped. A row with a null in its
    natural key is its own survivor, and so is every row if there is no key. A null in `map_key` keeps a
    row out of the map. `stage` writes rows down that are read several times, which a shuffled join does.
    """
    if not key:
        return survivors.select(SNAPSHOT, OLD_ID, NEW_ID)
    casts = casts or {}
    parts = [F.col(k).cast(casts[k]) if k in casts else F.col(k) for k in key]
    names = [f"_n{i}" for i in range(len(parts))]
    referable = ~any_null(map_key)

    keyed = rows.where(referable & ~any_null(key)).select(
        SNAPSHOT, OLD_ID, *(p.alias(n) for p, n in zip(parts, names))
    )
    targets = survivors.where(~any_null(key)).select(
        *(p.alias(n) for p, n in zip(parts, names)), NEW_ID
    )
    sized = Sized.of(targets, rows_kept)
    if stage is not None and not sized.fits(limit):
        keyed = stage(keyed)
    matched = lookup(
        keyed,
        sized,
        {n: n for n in names},
        {NEW_ID: NEW_ID},
        "inner",
        (SNAPSHOT, OLD_ID),
        limit,
    ).select(SNAPSHOT, OLD_ID, NEW_ID)
    own = survivors.where(referable & any_null(key)).select(SNAPSHOT, OLD_ID, NEW_ID)
    return matched.unionByName(own)


def rank_zip_map(
    rows: DataFrame,
    survivors: DataFrame,
    weak_key: Sequence[str],
    staging: Staging,
    name: str,
    survivor_order: Sequence[str] = (RANK, OLD_ID),
) -> DataFrame:
    """(snapshot_id, old_id, new_id) by a looser key, one to one.

    Inside one key the i-th row of a snapshot, by old id, goes to the i-th survivor, as long as that
    survivor was already there when the snapshot was merged. Rows left over have no new id.
    """
    weak = list(weak_key)
    numbered = number_within(
        rows.select(SNAPSHOT, RANK, OLD_ID, *weak).dropna(subset=weak),
        [SNAPSHOT, *weak],
        [OLD_ID],
        staging,
        f"{name}_zip_rows",
    )
    targets = number_within(
        survivors.select(*weak, *dict.fromkeys([*survivor_order, RANK]), NEW_ID).dropna(subset=weak),
        weak,
        list(survivor_order),
        staging,
        f"{name}_zip_targets",
    )
    # (key, number) is unique on the right and at most once per snapshot on the left: no hot keys.
    left = numbered.select(SNAPSHOT, F.col(RANK).alias("_rank"), OLD_ID, *weak, "_rn")
    right = targets.select(*weak, "_rn", RANK, NEW_ID)
    joined = left.join(right, [*weak, "_rn"], "inner").where(F.col(RANK) <= F.col("_rank"))
    return joined.select(SNAPSHOT, OLD_ID, NEW_ID)

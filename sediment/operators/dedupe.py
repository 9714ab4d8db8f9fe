"""One row per natural key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.functions.expressions import any_null
from sediment.operators.lookup import Sized, lookup
from sediment.staging import Staging


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row by `order` of every key; null parts count as equal.

    Catalyst turns `row_number = 1` into a limit per key ahead of the shuffle, so each task sends at
    most one row per key, however many copies a key has.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def keyed_distinct(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    row_id: Sequence[str] | None = None,
    casts: dict[str, str] | None = None,
) -> DataFrame:
    """The first row by `order` of every key, and every row whose key has a null.

    With `row_id` (columns that identify a row) a row with a null in its key becomes a group of its
    own, which spreads such rows over all tasks in the same single shuffle. Without it they are split off.
    """
    # Only a key that is compared as another type travels twice.
    casts = {k: kind for k, kind in (casts or {}).items() if k in key}
    names = [f"_p{i}" if k in casts else k for i, k in enumerate(key)]
    copies = {n: F.col(k).cast(casts[k]) for k, n in zip(key, names) if k in casts}
    loose = any_null(key)
    keyed = df.withColumns(copies) if copies else df
    if row_id:
        tags = {f"_t{i}": F.when(loose, F.col(c)) for i, c in enumerate(row_id)}
        return first_per_key(keyed.withColumns(tags), [*names, *tags], order).drop(*copies, *tags)
    unique = first_per_key(keyed.where(~loose), names, order).drop(*copies)
    return unique.unionByName(df.where(loose))


def deciding(keys: Sequence[Sequence[str]]) -> list[Sequence[str]]:
    """The keys that hold no other key, each once."""
    distinct: dict[frozenset, Sequence[str]] = {}
    for k in keys:
        distinct.setdefault(frozenset(k), k)
    return [k for columns, k in distinct.items() if not any(other < columns for other in distinct)]


def distinct_on_all(
    df: DataFrame,
    keys: Sequence[Sequence[str]],
    order: Sequence[str],
    row_id: Sequence[str],
    staging: Staging,
    name: str,
) -> DataFrame:
    """The rows that stay when they are added one by one by `order` and a row repeating any of `keys` is left out.

    Rows that share a key share every key within it, so only keys that hold no other one decide. If that is one key, its first rows stay. Else
    each round keeps the rows that come first in all their keys and drops those that share a key with
    a kept row; the rest waits for the next round. `order` must tell all rows apart.
    """
    keys = deciding(keys)
    if len(keys) == 1:
        return keyed_distinct(df, keys[0], [F.col(c) for c in order], row_id)
    columns = list(dict.fromkeys([*row_id, *order, *(c for k in keys for c in k)]))
    waiting = staging.write(f"{name}/round0", df.select(*columns))
    kept: list[DataFrame] = []
    left = waiting.count()
    while left:
        place = F.struct(*order)
        tagged = waiting
        for i, key in enumerate(keys):
            firsts = waiting.dropna(subset=list(key)).groupBy(*key).agg(F.min(place).alias("_first"))
            known = Sized.of(staging.write(f"{name}/round{len(kept)}_first{i}", firsts))
            tagged = lookup(tagged, known, {c: c for c in key}, {"_first": f"_first{i}"}, spread=row_id, keys_from=waiting)
        leads = F.lit(True)
        for i in range(len(keys)):
            leads = leads & (F.col(f"_first{i}").isNull() | (F.col(f"_first{i}") == place))
        tagged = staging.write(f"{name}/round{len(kept)}_tagged", tagged.withColumn("_leads", leads))
        winners = tagged.where("_leads").select(*columns)
        rest = tagged.where(~F.col("_leads")).select(*columns)
        for i, key in enumerate(keys):
            taken = winners.dropna(subset=list(key)).select(*key, F.lit(1).alias("_taken"))
            known = Sized.of(staging.write(f"{name}/round{len(kept)}_taken{i}", taken))
            rest = lookup(rest, known, {c: c for c in key}, {"_taken": "_taken"}, spread=row_id, keys_from=waiting)
            rest = rest.where(F.col("_taken").isNull()).drop("_taken")
        kept.append(winners)
        waiting = staging.write(f"{name}/round{len(kept)}", rest)
        left = waiting.count()
    if not kept:
        return df
    ids = reduce(DataFrame.unionByName, kept).select(*row_id)
    return df.join(ids, list(row_id), "left_semi")

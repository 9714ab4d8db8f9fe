"""Rewrite foreign keys through the id maps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.names import match_rule
from sediment.operators.lookup import Sized, lookup
from sediment.specs import FK_RULES, NEW_ID, OLD_ID, SNAPSHOT, FkRule

# Tells rows apart where ids are present and unique.
ROW = (SNAPSHOT, OLD_ID)
# The place of a written row: what tells rows apart where their ids may repeat or be missing.
PLACE = "_place"


def placed(df: DataFrame) -> DataFrame:
    """`df` with the place of each row. Places hold once the result is written, so it has to be before they are joined on."""
    return df.withColumn(PLACE, F.monotonically_increasing_id())


def foreign_keys(table: str, columns: Iterable[str], rules: Sequence[FkRule] = FK_RULES) -> dict[str, FkRule]:
    """The columns of `table` that are rewritten, each with its rule."""
    found = {}
    for column in columns:
        rule = match_rule(column, rules)
        if rule and table not in rule.verbatim_in:
            found[column] = rule
    return found


def remap(
    df: DataFrame,
    table: str,
    maps: Mapping[str, Sized],
    columns: Iterable[str] | None = None,
    rules: Sequence[FkRule] = FK_RULES,
    limit: int | None = None,
    row: Sequence[str] = (),
) -> DataFrame:
    """`df` with its foreign keys (or only those in `columns`) replaced by new ids.

    A reference without a new id becomes null, or 0 where its rule says so. A target table no
    snapshot has resolves nothing. `row` names columns that tell all rows apart: then several large maps are joined at once.
    """
    order = df.columns
    wanted = foreign_keys(table, order if columns is None else columns, rules)
    df = df.withColumns({c: F.col(c).cast("long") for c in wanted})
    large = {c: r for c, r in wanted.items() if r.target in maps and not maps[r.target].fits(limit)}
    if row and len(large) > 1:
        # One shuffled lookup for all of them: the references travel alone, the other columns once.
        small = {c: r for c, r in wanted.items() if c not in large}
        rest = _resolve(df.drop(*large), table, maps, small, limit)
        found = _at_once(df, maps, large, row)
        joined = rest.join(found, list(row)[::-1], "left")
        return joined.withColumns({c: _sentinel(F.col(c), table, r) for c, r in large.items()}).select(*order)
    return _resolve(df, table, maps, wanted, limit).select(*order)


def _sentinel(new: Column, table: str, rule: FkRule) -> Column:
    return (F.coalesce(new, F.lit(0)) if table in rule.zero_in else new).cast("long")


def _at_once(df: DataFrame, maps: Mapping[str, Sized], wanted: Mapping[str, FkRule], row: Sequence[str]) -> DataFrame:
    """`row` and the new ids of `wanted`, for rows with a reference: a row per reference, one join with all maps, a row per row again."""
    targets = list(dict.fromkeys(r.target for r in wanted.values()))
    columns = list(wanted)
    references = [
        F.struct(F.lit(i).alias("at"), F.lit(targets.index(wanted[c].target)).alias("target"), F.col(c).alias("old"))
        for i, c in enumerate(columns)
    ]
    kept = dict.fromkeys([SNAPSHOT, *row])
    long = df.select(*kept, F.explode(F.array(*references)).alias("r")).select(*kept, "r.*").where(F.col("old").isNotNull())
    every = reduce(
        DataFrame.unionByName,
        (
            maps[t].df.select(F.lit(i).alias("target"), F.col(SNAPSHOT), F.col(OLD_ID).alias("old"), NEW_ID)
            for i, t in enumerate(targets)
        ),
    )
    sized = Sized(every, sum(maps[t].rows for t in targets), sum(maps[t].bytes for t in targets))
    on = {"old": "old", "target": "target", SNAPSHOT: SNAPSHOT}
    # Some of the maps does not fit, so neither do all of them.
    found = lookup(long, sized, on, {NEW_ID: "_new"}, "inner", (*row, "at"), limit=0)
    return found.groupBy(*row).agg(*(F.max(F.when(F.col("at") == i, F.col("_new"))).alias(c) for i, c in enumerate(columns)))


def _resolve(
    df: DataFrame, table: str, maps: Mapping[str, Sized], wanted: Mapping[str, FkRule], limit: int | None
) -> DataFrame:
    source = df
    spread = ROW if set(ROW) <= set(df.columns) else ()
    for column, rule in wanted.items():
        if rule.target in maps:
            df = lookup(
                df,
                maps[rule.target],
                {column: OLD_ID, SNAPSHOT: SNAPSHOT},
                {NEW_ID: "_new"},
                spread=spread,
                limit=limit,
                keys_from=source,
            )
        else:
            df = df.withColumn("_new", F.lit(None).cast("long"))
        df = df.withColumn(column, _sentinel(F.col("_new"), table, rule)).drop("_new")
    return df

"""Bring the tables of several snapshots to the base snapshot's columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.names import common
from sediment.specs import ID, OLD_ID


def has_surrogate(columns: Sequence[str]) -> bool:
    """Whether the table's `_id` is its first column, and so is renumbered."""
    return bool(columns) and columns[0] == ID


def converted(column: str, have: T.DataType, want: T.DataType) -> Column:
    """The column as the base types it; a value that does not fit becomes null."""
    return F.col(column) if have == want else F.col(column).try_cast(want).alias(column)


def align(
    df: DataFrame,
    base: T.StructType,
    defaults: dict[str, object] | None = None,
    keep: Sequence[str] = (),
    renumber: bool = True,
) -> DataFrame:
    """`df` with the base's columns in the base's order.

    Columns the base lacks go; columns `df` lacks get their default or null. `_id` is kept as `old_id`;
    with `renumber` under that name only, as new ids replace it. Columns in `keep` stay as they are.
    """
    defaults = defaults or {}
    have = {f.name: f.dataType for f in df.schema.fields}
    picked = [F.col(c) for c in keep]
    if ID in base.names:
        old = F.col(ID) if ID in have else F.lit(None)
        picked.append(old.cast("long").alias(OLD_ID))
    for field in base.fields:
        if field.name == ID and renumber:
            continue
        if field.name in have:
            picked.append(converted(field.name, have[field.name], field.dataType))
        else:
            picked.append(F.lit(defaults.get(field.name)).cast(field.dataType).alias(field.name))
    return df.select(*picked)


def common_columns(columns: Sequence[str], base: Sequence[str]) -> list[str]:
    """Names of `columns` the base has too; a leading surrogate does not count."""
    names = common(columns, base)
    return names[1:] if has_surrogate(columns) and names[:1] == [ID] else names


def lossy(have: T.DataType, want: T.DataType) -> bool:
    """Whether a value of type `have` may not fit type `want`."""
    widening = isinstance(have, T.IntegralType) and isinstance(want, T.LongType)
    return not (have == want or widening or isinstance(want, T.StringType))


def cast_losses(df: DataFrame, base: T.StructType, *by: str) -> DataFrame:
    """(by, column, n) for each column that may lose values in the conversion: how many become null."""
    wanted = {f.name: f.dataType for f in base.fields}
    columns = [c for c in lossy_columns(df.schema, base) if c not in by]
    lost = (F.col(c).isNotNull() & F.col(c).try_cast(wanted[c]).isNull() for c in columns)
    counted = df.groupBy(*by).agg(*(F.count_if(x).alias(c) for x, c in zip(lost, columns)))
    pairs = (F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns)
    return counted.select(*by, F.inline(F.array(*pairs)))


def lossy_columns(have: T.StructType, base: T.StructType) -> list[str]:
    wanted = {f.name: f.dataType for f in base.fields}
    return [f.name for f in have.fields if f.name in wanted and lossy(f.dataType, wanted[f.name])]

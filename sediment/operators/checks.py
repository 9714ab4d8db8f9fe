"""Checks ahead of a write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.errors import DuplicateKey, NullValue
from sediment.functions.expressions import any_null


def split_nulls(df: DataFrame, not_null: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the NOT NULL columns, and those that do not."""
    present = [c for c in not_null if c in df.columns]
    breach = any_null(present)
    return df.where(~breach), df.where(breach)


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys without a null that occur more than once, with their number of rows."""
    counted = df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, key: Sequence[str], table: str) -> None:
    """Stop if a key of `df` repeats; a few of the keys are named."""
    found = duplicates(df, key).limit(5).collect()
    if found:
        shown = "; ".join(", ".join(f"{k}={row[k]!r}" for k in key) for row in found)
        raise DuplicateKey(f"{table}: repeated key: {shown}")


def assert_not_null(df: DataFrame, columns: Sequence[str], table: str) -> None:
    """Stop if a column that may hold no null does."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return
    found = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in present)).first()
    if any(found):
        shown = ", ".join(f"{c} in {found[c]} rows" for c in present if found[c])
        raise NullValue(f"{table}: null where none may be: {shown}")


def repeated_ids(rows: DataFrame, by: str, id_column: str) -> DataFrame:
    """(`by`, `id_column`, n): ids that are missing or repeat under one value of `by`.

    64 neighbouring ids share a word of bits, and a word has as many bits as rows unless one repeats. So a task sends a row for
    64 ids at most where ids are dense, and only rows of words that do not add up are counted by id.
    """
    word, bit = F.shiftright(id_column, 6).alias("_word"), F.expr(f"shiftleft(1L, cast(`{id_column}` & 63 as int))")
    words = rows.groupBy(by, word).agg(F.count(F.lit(1)).alias("_n"), F.bit_or(bit).alias("_bits"))
    doubtful = words.where(F.col("_word").isNull() | (F.bit_count("_bits") < F.col("_n"))).select(F.col(by).alias("_by"), "_word")
    if doubtful.isEmpty():
        return rows.select(by, id_column).limit(0).withColumn("n", F.lit(0).cast("long"))
    counted = rows.groupBy(by, id_column).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col(id_column).isNull() | (F.col("n") > 1))

"""Row predicates and small column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message type codes.
TEXT_TYPE = 0
SYSTEM_TYPE = 7


def displayable() -> Column:
    """Messages a chat list can show: anything but system rows, and text rows only with a text."""
    kind = F.col("message_type")
    return ~kind.isin(TEXT_TYPE, SYSTEM_TYPE) | ((kind == TEXT_TYPE) & F.col("text_data").isNotNull())


def not_system() -> Column:
    return F.col("message_type") != SYSTEM_TYPE


def quotes_something() -> Column:
    return F.col("quoted_row_id").isNotNull() & (F.col("quoted_row_id") != 0)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns), F.lit(False))


def long_array(values: Sequence[int]) -> Column:
    """A constant array of longs as one literal, whatever its length."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast("array<bigint>")

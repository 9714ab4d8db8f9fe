"""State that follows from the merged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.expressions import displayable, not_system
from sediment.functions.names import pointer_columns
from sediment.operators.dedupe import first_per_key
from sediment.specs import ID, TIME

# Chat columns cleared on every chat, and search-index properties.
REACTION_COLUMNS = ("last_message_reaction_row_id", "last_seen_message_reaction_row_id")
INDEX_START_KEY = "fts_index_start"
INDEX_READY_KEY = "fts_ready"


def chat_activity(messages: DataFrame) -> DataFrame:
    """Per chat: last displayable id, newest non-system time, and whether any non-system message exists.

    One aggregation for all three, with partial sums ahead of the shuffle.
    """
    return (
        messages.where(F.col("chat_row_id").isNotNull())
        .groupBy("chat_row_id")
        .agg(
            F.max(F.when(displayable(), F.col(ID))).alias("_last_id"),
            F.max(F.when(not_system(), F.col(TIME))).alias("_latest"),
            F.count_if(not_system()).alias("_n"),
        )
    )


def refresh_chats(chats: DataFrame, messages: DataFrame, stale: str = "null") -> DataFrame:
    """Chats with pointers, hidden flag, reaction columns and sort time rebuilt from the messages.

    Each part applies only if its columns exist. `stale`: "keep" leaves the pointers of chats with
    nothing to show as they were, "null" clears them.
    """
    if stale not in ("keep", "null"):
        raise ValueError(f"stale must be 'keep' or 'null', not {stale!r}")
    have = set(chats.columns)
    pointers = pointer_columns(chats.columns)
    activity = chat_activity(messages).withColumnRenamed("chat_row_id", "_chat")
    joined = chats.join(activity, F.col(ID) == F.col("_chat"), "left")
    alive = F.coalesce("_n", F.lit(0)) > 0

    new: dict[str, Column] = {}
    for c in pointers:
        kind = chats.schema[c].dataType
        last = F.col("_last_id").cast(kind)
        new[c] = F.coalesce(last, F.col(c)) if stale == "keep" else last
    for c in REACTION_COLUMNS:
        if c in have:
            new[c] = F.lit(None).cast(chats.schema[c].dataType)
    if "hidden" in have:
        new["hidden"] = F.when(alive, 0).otherwise(1).cast(chats.schema["hidden"].dataType)
    if {"hidden", "sort_timestamp"} <= have:
        kind = chats.schema["sort_timestamp"].dataType
        new["sort_timestamp"] = F.when(alive, F.col("_latest").cast(kind)).otherwise(F.col("sort_timestamp"))
    return joined.select(*(new[c].alias(c) if c in new else F.col(c) for c in chats.columns))


def most_frequent(df: DataFrame, by: str, order: Sequence[str] = (ID,)) -> DataFrame:
    """The row with the highest message_count of each contact; ties go to the first by `order`.

    Rows without a contact count as one contact.
    """
    return first_per_key(df, [by], [F.desc_nulls_last("message_count"), *(F.col(c) for c in order)])


def reset_index_state(props: DataFrame) -> DataFrame:
    """Properties that make the store rebuild its search index."""
    kept = props.where(F.col("key").isNull() | (F.col("key") != INDEX_START_KEY))
    value = F.when(F.col("key") == INDEX_READY_KEY, F.lit("0")).otherwise(F.col("value"))
    return kept.withColumn("value", value.cast(props.schema["value"].dataType))


def flag_quoting(messages: DataFrame, quoted: DataFrame, flag: int = 2) -> DataFrame:
    """lookup_tables = `flag` on messages that have a row in `quoted`."""
    ids = quoted.select(F.col("message_row_id").alias("_q")).distinct()
    joined = messages.join(ids, F.col(ID) == F.col("_q"), "left")
    value = F.when(F.col("_q").isNotNull(), F.lit(flag)).otherwise(F.col("lookup_tables"))
    return joined.withColumn("lookup_tables", value.cast("int")).select(*messages.columns)


def sort_by_id(messages: DataFrame) -> DataFrame:
    return messages.withColumn("sort_id", F.col(ID).cast(messages.schema["sort_id"].dataType))

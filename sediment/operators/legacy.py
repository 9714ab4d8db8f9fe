"""Rows of the legacy schema, which stores contacts as text, in the normalized one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.errors import DuplicateKey
from sediment.functions.expressions import quotes_something
from sediment.operators.checks import duplicates
from sediment.operators.lookup import Sized, lookup


@dataclass(frozen=True)
class Contacts:
    """Contact text to jid id, and contact text to the id of its chat."""

    jids: Sized
    chats: Sized
    limit: int | None = None

    @classmethod
    def of(cls, jid: DataFrame, chat: DataFrame, limit: int | None = None) -> "Contacts":
        jids = Sized.of(jid.select("raw_string", F.col("_id").alias("jid_id")))
        owners = Sized.of(jid.select("_id", "raw_string"), jids.rows)
        chats = lookup(
            chat.select(F.col("_id").alias("chat_id"), "jid_row_id"),
            owners,
            {"jid_row_id": "_id"},
            {"raw_string": "raw_string"},
            "inner",
            ("chat_id",),
            limit,
        ).select("raw_string", "chat_id")
        return cls(jids, Sized.of(chats), limit)

    def with_chat(
        self, df: DataFrame, text: str, spread: str, keys_from: DataFrame | None = None
    ) -> DataFrame:
        """Adds `_chat`; rows whose contact has no chat go."""
        take = {"chat_id": "_chat"}
        return lookup(df, self.chats, {text: "raw_string"}, take, "inner", (spread,), self.limit, keys_from)

    def with_jid(
        self, df: DataFrame, text: str, spread: str, how: str = "left", keys_from: DataFrame | None = None
    ) -> DataFrame:
        """Adds `_jid`."""
        take = {"jid_id": "_jid"}
        return lookup(df, self.jids, {text: "raw_string"}, take, how, (spread,), self.limit, keys_from)

    def fit(self) -> bool:
        return self.jids.fits(self.limit) and self.chats.fits(self.limit)


def messages(legacy: DataFrame, contacts: Contacts) -> DataFrame:
    texts = legacy.select("_id", "key_remote_jid", "remote_resource")
    if contacts.fit():
        texts = legacy
    df = contacts.with_chat(texts, "key_remote_jid", "_id")
    df = contacts.with_jid(df, "remote_resource", "_id", keys_from=texts)
    if not contacts.fit():
        # Shuffled lookups carry the contact texts alone; the other columns travel once.
        df = legacy.join(df.select("_id", "_chat", "_jid"), "_id")
    return df.select(
        "_id",
        F.col("_chat").alias("chat_row_id"),
        F.coalesce("_jid", F.lit(0)).alias("sender_jid_row_id"),
        F.col("key_from_me").alias("from_me"),
        F.col("data").alias("text_data"),
        "key_id",
        "status",
        "recipient_count",
        "participant_hash",
        "origin",
        "timestamp",
        "received_timestamp",
        F.col("media_wa_type").alias("message_type"),
        F.lit(0).alias("broadcast"),
        "receipt_server_timestamp",
        "starred",
        F.col("_id").alias("sort_id"),
    )


def links(legacy: DataFrame, contacts: Contacts) -> DataFrame:
    df = contacts.with_chat(legacy, "key_remote_jid", "_id")
    return df.select("_id", F.col("_chat").alias("chat_row_id"), "message_row_id", "link_index")


def quotes(legacy_messages: DataFrame, legacy_quotes: DataFrame, contacts: Contacts) -> DataFrame:
    """One row per quoting message, with the quoted row's content and the chat of the quoted row's contact."""
    quoting = legacy_messages.where(quotes_something()).select(F.col("_id").alias("message_row_id"), "quoted_row_id")
    content = legacy_quotes.select(
        "_id",
        "key_remote_jid",
        F.col("key_from_me").alias("from_me"),
        "key_id",
        "remote_resource",
        "timestamp",
        F.col("media_wa_type").alias("message_type"),
        "origin",
        F.col("data").alias("text_data"),
        "payment_transaction_id",
    )
    joined = lookup(
        quoting,
        Sized.of(content),
        {"quoted_row_id": "_id"},
        {c: c for c in content.columns if c != "_id"},
        "inner",
        ("message_row_id",),
        contacts.limit,
    )
    df = contacts.with_chat(joined, "key_remote_jid", "message_row_id")
    df = contacts.with_jid(df, "remote_resource", "message_row_id")
    return df.select(
        "message_row_id",
        F.col("_chat").alias("chat_row_id"),
        F.col("_chat").alias("parent_message_chat_row_id"),
        "from_me",
        F.coalesce("_jid", F.lit(0)).alias("sender_jid_row_id"),
        "key_id",
        "timestamp",
        "message_type",
        "origin",
        "text_data",
        "payment_transaction_id",
        F.lit(0).alias("lookup_tables"),
    )


def vcards(legacy: DataFrame) -> DataFrame:
    return legacy.select("_id", "message_row_id", "vcard")


def vcard_jids(legacy: DataFrame, contacts: Contacts) -> DataFrame:
    df = contacts.with_jid(legacy, "vcard_jid", "_id", "inner")
    return df.select("_id", F.col("_jid").alias("vcard_jid_row_id"), "vcard_row_id", "message_row_id")


def frequents(legacy: DataFrame, contacts: Contacts) -> DataFrame:
    df = contacts.with_jid(legacy, "jid", "_id", "inner")
    return df.select("_id", F.col("_jid").alias("jid_row_id"), "type", "message_count")


def thumbnails(legacy: DataFrame, legacy_messages: DataFrame, limit: int | None = None) -> DataFrame:
    """One row per message with a thumbnail of its key."""
    pictures = legacy.select("key_id", "thumbnail")
    joined = lookup(
        legacy_messages.select(F.col("_id").alias("message_row_id"), "key_id"),
        Sized.of(pictures),
        {"key_id": "key_id"},
        {"thumbnail": "thumbnail"},
        "inner",
        ("message_row_id",),
        limit,
    )
    return joined.select("message_row_id", "thumbnail")


def assert_one_thumbnail(legacy: DataFrame, legacy_messages: DataFrame) -> None:
    """Stop if a message would get two thumbnails, before any pair is made."""
    repeated = duplicates(legacy, ["key_id"])
    used = legacy_messages.select("key_id").distinct()
    hit = repeated.join(used, "key_id", "left_semi").limit(5).collect()
    if hit:
        raise DuplicateKey("message_thumbnail: repeated key: " + "; ".join(f"key_id={r['key_id']!r}" for r in hit))

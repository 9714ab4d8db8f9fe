"""What the job knows about tables: natural keys, foreign-key naming rules, fixed names."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

SNAPSHOT = "snapshot_id"
RANK = "merge_rank"
OLD_ID = "old_id"
NEW_ID = "new_id"
ID = "_id"
TIME = "timestamp"


@dataclass(frozen=True)
class FkRule:
    """Columns whose name matches one of `patterns` hold ids of `target`.

    `verbatim_in`: tables whose matching columns are copied as they are.
    `zero_in`: tables where an unresolved reference becomes 0 instead of null.
    """

    patterns: tuple[str, ...]
    target: str
    verbatim_in: frozenset[str] = frozenset()
    zero_in: frozenset[str] = frozenset()


@dataclass(frozen=True)
class WeakKey:
    """One part of the looser key used by `rank_zip` maps.

    A plain part is a column of the table (remapped if it is a foreign key). With `parent`, it is
    column `parent_column` of the row of `parent` that `column` points at inside the same snapshot.
    """

    column: str
    parent: str | None = None
    parent_column: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """How one table takes part in a merge.

    natural_key  columns that identify a row across snapshots (after foreign keys are remapped)
    key_casts    type a key column is compared as
    map_key      columns that must not be null for a row to be referable at all
    weak_key     looser key for `rank_zip` maps
    time_ordered rows without a time are dropped and new ids follow the time
    not_null     columns whose null sends a row to quarantine
    unique       further keys the store declares; a row that repeats one of a kept row is dropped
    defaults     values for columns a snapshot lacks
    """

    name: str
    kind: str = "minor"
    natural_key: tuple[str, ...] = ()
    key_casts: dict[str, str] = field(default_factory=dict)
    map_key: tuple[str, ...] = ()
    weak_key: tuple[WeakKey, ...] = ()
    time_ordered: bool = False
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def is_main(self) -> bool:
        return self.kind == "main"

    @property
    def keys(self) -> tuple[tuple[str, ...], ...]:
        """All keys of which kept rows must not share one, the natural key first."""
        return tuple(dict.fromkeys(k for k in (self.natural_key, *self.unique) if k))

    def with_declared(
        self, not_null: tuple[str, ...], unique: tuple[tuple[str, ...], ...], defaults: dict[str, object]
    ) -> "TableSpec":
        """Adds what the base snapshot itself declares."""
        return replace(
            self,
            not_null=tuple(dict.fromkeys((*self.not_null, *not_null))),
            unique=tuple(dict.fromkeys((*self.unique, *unique))),
            defaults={**defaults, **self.defaults},
        )


# Tables other tables point at, in the order their keys depend on each other.
MAIN_TABLES = (
    "jid",
    "chat",
    "message",
    "message_add_on",
    "call_log",
    "quick_replies",
    "message_vcard",
    "group_participant_user",
    "labels",
    "reporting_info",
)

# Foreign-key naming rules; the first match wins and case matters.
FK_RULES = (
    FkRule(
        ("*jid_row_id*", "business_owner_jid", "seller_jid", "*lid_row_id*"),
        "jid",
        zero_in=frozenset({"call_log", "missed_call_logs", "message"}),
    ),
    FkRule(("*chat_row_id*",), "chat"),
    FkRule(("*message_row_id*", "*message_table_id*"), "message", verbatim_in=frozenset({"chat"})),
    FkRule(("*call_log_row_id*", "*call_logs_row_id*"), "call_log"),
    FkRule(("*message_add_on_row_id*",), "message_add_on"),
    FkRule(("*vcard_row_id*",), "message_vcard"),
    FkRule(("*quick_reply_id*",), "quick_replies"),
    FkRule(("*reporting_info_row_id*",), "reporting_info"),
    FkRule(("*label_id*",), "labels"),
    FkRule(("group_participant*_row_id",), "group_participant_user"),
)

# Names left out of a merge (anywhere in the name, any case; or the whole name).
UNMERGED_NAME_PARTS = ("fts", "view")
UNMERGED_NAMES = ("props", "sqlite_sequence")

# Tables the migration maps itself or leaves out of the plain copy.
MIGRATED_NAMES = (
    "message",
    "messages",
    "message_link",
    "messages_links",
    "message_quoted",
    "messages_quotes",
    "message_vcard",
    "message_vcards",
    "message_vcard_jid",
    "message_vcards_jids",
    "frequents",
    "frequent",
    "sqlite_sequence",
    "message_thumbnail",
    "message_thumbnails",
    "backup_changes",
)

_MESSAGE_KEY = ("chat_row_id", "from_me", "key_id", "sender_jid_row_id")


def default_specs() -> dict[str, TableSpec]:
    """Main tables with their natural keys. Any other table is a minor one."""
    specs = (
        TableSpec("jid", "main", ("raw_string",), map_key=("raw_string",), weak_key=(WeakKey("raw_string"),)),
        TableSpec(
            "chat",
            "main",
            ("jid_row_id",),
            map_key=("jid_row_id",),
            weak_key=(WeakKey("jid_row_id", "jid", "raw_string"),),
        ),
        TableSpec(
            "message",
            "main",
            _MESSAGE_KEY,
            map_key=("key_id", "from_me"),
            weak_key=(WeakKey("key_id"), WeakKey("from_me")),
            time_ordered=True,
        ),
        TableSpec(
            "message_add_on",
            "main",
            _MESSAGE_KEY,
            map_key=("key_id", "from_me"),
            weak_key=(WeakKey("key_id"), WeakKey("from_me")),
            time_ordered=True,
        ),
        TableSpec(
            "call_log",
            "main",
            ("call_id", "from_me", "jid_row_id", "transaction_id"),
            map_key=("call_id",),
            weak_key=(WeakKey("call_id"),),
            time_ordered=True,
        ),
        TableSpec("quick_replies", "main", ("title",), map_key=("title",), weak_key=(WeakKey("title"),)),
        TableSpec(
            "message_vcard",
            "main",
            ("message_row_id", "vcard"),
            map_key=("message_row_id",),
            weak_key=(WeakKey("message_row_id", "message", "key_id"),),
        ),
        TableSpec(
            "group_participant_user",
            "main",
            ("group_jid_row_id", "user_jid_row_id"),
            map_key=("group_jid_row_id", "user_jid_row_id"),
            weak_key=(
                WeakKey("group_jid_row_id", "jid", "raw_string"),
                WeakKey("user_jid_row_id", "jid", "raw_string"),
            ),
        ),
        TableSpec("labels", "main", ("label_name",), map_key=("label_name",), weak_key=(WeakKey("label_name"),)),
        TableSpec(
            "reporting_info",
            "main",
            ("reporting_tag", "stanza_id"),
            key_casts={"reporting_tag": "binary"},
            map_key=("message_row_id",),
            weak_key=(WeakKey("message_row_id"),),
        ),
    )
    return {spec.name: spec for spec in specs}

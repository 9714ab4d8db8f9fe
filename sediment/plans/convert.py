"""Migrate a legacy archive to the normalized schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.functions.names import common, listing, plain_copies
from sediment.operators import derive, legacy
from sediment.operators.align import converted
from sediment.operators.checks import assert_not_null, assert_unique
from sediment.operators.legacy import Contacts
from sediment.plans.merge import EMPTIED
from sediment.sources.archive import Archive, Constraints, open_archive
from sediment.sources.sink import Publisher, check_output
from sediment.staging import Staging

# The key an append to a migrated table must not repeat, and the legacy tables it is made of.
APPEND_KEYS = {
    "message": "_id",
    "message_link": "_id",
    "message_quoted": "message_row_id",
    "message_vcard": "_id",
    "message_vcard_jid": "_id",
    "frequent": "_id",
    "message_thumbnail": "message_row_id",
}
SOURCES = {
    "message": ("messages",),
    "message_link": ("messages_links",),
    "message_quoted": ("messages", "messages_quotes"),
    "message_vcard": ("messages_vcards",),
    "message_vcard_jid": ("messages_vcards_jids",),
    "frequent": ("frequents",),
    "message_thumbnail": ("messages", "message_thumbnails"),
}
# Legacy tables that no longer exist once the tables above are made of them.
LEGACY_NAMES = ("messages", "messages_links", "messages_quotes", "messages_vcards", "messages_vcards_jids", "frequents", "message_thumbnails")


@dataclass
class ConvertResult:
    tables: dict[str, DataFrame]
    notes: list[str] = field(default_factory=list)
    staging: Staging | None = None

    def discard(self) -> None:
        """Deletes the intermediate tables that unwritten results still read from."""
        if self.staging is not None:
            self.staging.drop()


def fill(df: DataFrame, target: T.StructType | None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """`df` in the target's columns and types; columns `df` lacks have their default or are null."""
    if target is None:
        return df
    have = {f.name: f.dataType for f in df.schema.fields}
    defaults = defaults or {}
    return df.select(
        *(
            converted(f.name, have[f.name], f.dataType)
            if f.name in have
            else F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
            for f in target.fields
        )
    )


def copy_common(
    df: DataFrame, target: T.StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame | None:
    """The plain copy: shared columns in the target's order, ids as they are. None if nothing is shared."""
    return fill(df, target, defaults) if common(target.names, df.columns) else None


class Target:
    """Tables of the new schema, with what it declares if it is an archive; `schema` is None for any if there is none."""

    def __init__(self, given: "Archive | Mapping[str, T.StructType] | None", archive: Archive):
        self.given = given is not None
        if given is None or isinstance(given, Mapping):
            self._schemas, self._declared = dict(given or {}), {}
        else:
            self._schemas = {t: given.schema(t) for t in given.tables()}
            self._declared = {t: given.constraints(t) for t in given.tables()}
        # Without a target every legacy table that is not made into another is copied as it is.
        made = {s for sources in SOURCES.values() for s in sources if s in LEGACY_NAMES}
        copies = {t: archive.schema(t) for t in archive.tables() if t not in made}
        self.goal = self._schemas if self.given else copies

    def schema(self, table: str) -> T.StructType | None:
        return self._schemas.get(table)

    def declared(self, table: str) -> Constraints:
        return self._declared.get(table, Constraints())

    def check(self, df: DataFrame, table: str, key: str | None) -> None:
        """Stops the job at a key that repeats, or a null where none may be."""
        declared = self.declared(table)
        for k in dict.fromkeys([*([(key,)] if key else []), *declared.unique]):
            if set(k) <= set(df.columns):
                assert_unique(df, list(k), table)
        assert_not_null(df, declared.not_null, table)


def migrations(read: Callable[[str], DataFrame], contacts: Contacts) -> dict[str, Callable[[], DataFrame]]:
    """How each migrated table is made."""

    def thumbnails() -> DataFrame:
        legacy.assert_one_thumbnail(read("message_thumbnails"), read("messages"))
        return legacy.thumbnails(read("message_thumbnails"), read("messages"), contacts.limit)

    return {
        "message_quoted": lambda: legacy.quotes(read("messages"), read("messages_quotes"), contacts),
        "message": lambda: legacy.messages(read("messages"), contacts),
        "message_link": lambda: legacy.links(read("messages_links"), contacts),
        "message_vcard": lambda: legacy.vcards(read("messages_vcards")),
        "message_vcard_jid": lambda: legacy.vcard_jids(read("messages_vcards_jids"), contacts),
        "frequent": lambda: legacy.frequents(read("frequents"), contacts),
        "message_thumbnail": thumbnails,
    }


def convert_archive(
    spark: SparkSession,
    source: "str | Archive",
    out: str | None = None,
    target: "str | Archive | Mapping[str, T.StructType] | None" = None,
    broadcast_bytes: int | None = None,
    versioned: bool = False,
) -> ConvertResult:
    """Migrate `source`; with `out`, also write the archive there.

    target  the new schema: an archive (its columns, defaults, NOT NULL columns and unique keys hold), or columns by
            table. Without it the output has the mapped tables with their mapped columns and a copy of every
            other legacy table.

    A repeated key or a null in a NOT NULL column stops the job before anything is published.
    """
    archive = open_archive(spark, source)
    goal = Target(open_archive(spark, target) if isinstance(target, str) else target, archive)
    if out is None:
        staging = Staging(spark)
        try:
            result = _converted(spark, archive, staging.write, goal, broadcast_bytes)
        except BaseException:
            staging.drop()
            raise
        result.staging = staging
        return result
    if isinstance(source, str):
        check_output(spark, out, [source])
    with Publisher(spark, out, versioned) as publisher:
        result = _converted(spark, archive, publisher.write, goal, broadcast_bytes)
        publisher.declare({t: goal.declared(t) for t in result.tables})
        publisher.publish()
    tables = {t: spark.read.schema(df.schema).parquet(f"{publisher.home}/{t}") for t, df in result.tables.items()}
    return ConvertResult(tables, result.notes)


def _converted(
    spark: SparkSession,
    archive: Archive,
    store: Callable[[str, DataFrame], DataFrame],
    target: Target,
    broadcast_bytes: int | None,
) -> ConvertResult:
    notes: list[str] = []
    tables: dict[str, DataFrame] = {}
    for table in plain_copies(archive.tables(), target.goal):
        copied = copy_common(archive.read(table), target.goal[table], target.declared(table).defaults)
        if copied is None:
            notes.append(f"{table} not copied, no common columns")
            continue
        tables[table] = store(table, copied)
        has_id = "_id" in archive.schema(table).names and "_id" in target.goal[table].names
        target.check(tables[table], table, "_id" if has_id else None)

    contacts = Contacts.of(archive.read("jid"), archive.read("chat"), broadcast_bytes)
    for table, make in migrations(archive.read, contacts).items():
        missing = [t for t in SOURCES[table] if t not in archive.tables()]
        if missing:
            notes.append(f"{table} not made, no {listing(missing)}")
        elif target.given and target.schema(table) is None:
            notes.append(f"{table} not made, the target lacks it")
        else:
            df = make()
            if table == "message":
                df = df.withColumn("lookup_tables", F.lit(None).cast("int"))
                if "message_quoted" in tables:
                    df = derive.flag_quoting(df, tables["message_quoted"])
            df = fill(df, target.schema(table), target.declared(table).defaults)
            tables[table] = store(table, df)
            target.check(tables[table], table, APPEND_KEYS[table])
    if EMPTIED in target.goal:
        tables[EMPTIED] = store(EMPTIED, spark.createDataFrame([], target.goal[EMPTIED]))
    return ConvertResult(tables, notes)

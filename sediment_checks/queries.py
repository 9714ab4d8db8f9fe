"""The registered queries: each runs library operators over the derived snapshots."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment_checks.derived import PATHS, Given, LegacyFrames, snapshot_frames
from sediment.functions.names import listing
from sediment.operators import derive, legacy
from sediment.operators.align import align
from sediment.operators.checks import assert_unique
from sediment.operators.dedupe import first_per_key
from sediment.operators.keymap import rank_zip_map
from sediment.operators.legacy import Contacts
from sediment.operators.rank import checked_times, newest_times, ranking, snapshot_list
from sediment.plans.convert import convert_archive, copy_common
from sediment.plans.merge import Merge, merge_archives, together
from sediment.operators.lookup import BROADCAST_BYTES
from sediment.sources import sqlite
from sediment.sources.archive import FrameArchive, ParquetArchive, open_archive, read_union
from sediment.specs import ID, NEW_ID, OLD_ID, RANK, SNAPSHOT, TIME, TableSpec, default_specs
from sediment.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

# Main tables in key order with the key columns that are shown, and the other tables.
KEYS = {name: spec.natural_key for name, spec in default_specs().items()}
MAIN = tuple(KEYS)
MINOR = ("message_link", "frequent", "frequents", "missed_call_logs", "references_of_events")

# Main tables whose maps a table needs.
NEEDS = {
    "jid": (),
    "chat": ("jid",),
    "message": ("jid", "chat"),
    "message_add_on": ("jid", "chat", "message"),
    "call_log": ("jid",),
    "quick_replies": (),
    "message_vcard": ("jid", "chat", "message"),
    "group_participant_user": ("jid",),
    "labels": (),
    "reporting_info": ("jid", "chat", "message"),
    "message_link": ("jid", "chat", "message"),
    "missed_call_logs": ("jid",),
    "frequent": ("jid",),
    "frequents": (),
    "references_of_events": MAIN,
    "order_notes": ("jid", "chat", "message"),
}


def merge_of(
    spark: SparkSession,
    folder: str,
    tables: tuple[str, ...],
    build: Iterable[str],
    specs: dict[str, TableSpec] | None = None,
    **options,
) -> Merge:
    """A merge of the derived snapshots with the maps of `build` made."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    wanted = list(dict.fromkeys(["message", *build, *tables]))
    frames = snapshot_frames(Given(spark, folder), wanted)
    archives = [FrameArchive(path, of) for path, of in zip(PATHS, frames)]
    merge = Merge(spark, archives, specs or default_specs(), Staging(spark), main_tables=build, **options)
    merge.build_keys()
    return merge


def for_table(spark: SparkSession, folder: str, table: str, **options) -> Merge:
    return merge_of(spark, folder, (table,), (*NEEDS[table], *([table] if table in MAIN else [])), **options)


def dedupe(table: str, spark: SparkSession, folder: str) -> DataFrame:
    kept = for_table(spark, folder, table).survivors[table].rows
    return kept.select(F.col(NEW_ID).alias(ID), SNAPSHOT, OLD_ID, *KEYS[table])


def id_map(table: str, spark: SparkSession, folder: str) -> DataFrame:
    return for_table(spark, folder, table).maps[table].df


def main_rows(table: str, spark: SparkSession, folder: str) -> DataFrame:
    return for_table(spark, folder, table).main_table(table)


def minor_rows(table: str, spark: SparkSession, folder: str) -> DataFrame:
    return for_table(spark, folder, table).minor_table(table)


def merge_messages_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Latest displayable message and newest time of every chat of the merged archive."""
    merge = for_table(spark, folder, "message")
    activity = derive.chat_activity(merge.main_table("message"))
    chats = merge.survivors["chat"].rows.select(F.col(NEW_ID).alias("chat_id"), "jid_row_id")
    jids = merge.survivors["jid"].rows.select(F.col(NEW_ID).alias("jid_row_id"), "raw_string")
    named = chats.join(jids, "jid_row_id")
    joined = named.join(activity, F.col("chat_id") == F.col("chat_row_id"))
    return joined.select(
        "chat_id",
        "raw_string",
        F.col("_last_id").alias("last_id"),
        F.col("_latest").alias("latest"),
        F.col("_n").alias("n_messages"),
    )


def scan_snapshots_union(spark: SparkSession, folder: str) -> DataFrame:
    merge = merge_of(spark, folder, (), ())
    return merge.union("message", ["key_id", TIME, "status"]).select(SNAPSHOT, RANK, OLD_ID, "key_id", TIME, "status")


def align_common_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots of one table that differ in columns, types and column order, brought to a base's columns."""
    customer = Given(spark, folder)["customer"]
    base = T.StructType.fromDDL("_id bigint, raw_string string, nation int, segment string")
    ident = F.col("c_custkey").alias(ID)
    nation = F.col("c_nationkey").cast("string")
    shaped = (
        # Lacks two columns, has one of its own.
        customer.select(ident, F.col("c_name").alias("raw_string"), F.col("c_acctbal").alias("balance")),
        # Other column order, one column lacking.
        customer.select(ident, F.col("c_nationkey").alias("nation"), F.col("c_name").alias("raw_string")),
        # A text column where the base has a number, with values that are none.
        customer.select(
            ident,
            F.col("c_name").alias("raw_string"),
            F.when(F.col("c_custkey") % 4 == 0, F.lit("unknown")).otherwise(nation).alias("nation"),
            F.col("c_mktsegment").alias("segment"),
        ),
    )
    archives = [
        (i, FrameArchive(f"archive_{i}", {"jid": df.where(F.col(ID) % 6 != i)})) for i, df in enumerate(shaped)
    ]
    shape = lambda df, keep: align(df, base, {"segment": "none"}, keep)
    return read_union(spark, archives, "jid", base.names, shape)


def source_validation(spark: SparkSession, folder: str) -> DataFrame:
    orders = Given(spark, folder)["orders"]
    snapshot = (F.col("o_orderkey") % 5).cast("int")
    time = (
        F.when(snapshot == 3, F.lit(None))
        .when(snapshot == 4, F.lit(-1))
        .otherwise(F.unix_millis(F.col("o_orderdate").cast("timestamp")))
    )
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    messages = orders.select(snapshot.alias(SNAPSHOT), time.cast("long").alias(TIME))
    return checked_times(snapshot_list(spark, [f"archive_{i}" for i in range(5)]), messages)


def rank_query(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    frames = snapshot_frames(Given(spark, folder), ["message"])
    parts = (of["message"].select(F.lit(i).alias(SNAPSHOT), TIME) for i, of in enumerate(frames))
    times = newest_times(reduce(DataFrame.unionByName, parts))
    return ranking(snapshot_list(spark, PATHS).join(times, SNAPSHOT))


def reid_messages(spark: SparkSession, folder: str) -> DataFrame:
    messages = derive.sort_by_id(main_rows("message", spark, folder))
    return messages.select(ID, "sort_id", TIME, "key_id", "from_me", "status")


def map_rank_zip(spark: SparkSession, folder: str) -> DataFrame:
    """The one-to-one message map on the looser key, over strictly mapped chats and contacts."""
    merge = for_table(spark, folder, "message")
    rows = merge.union("message", ["key_id", "from_me"])
    kept = merge.survivors["message"].rows
    return rank_zip_map(rows, kept, ["key_id", "from_me"], merge.staging, "query", (RANK, TIME, OLD_ID))


def row_texts(table: str, df: DataFrame, names: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of any table as one text each, of the columns named or else the id and the table's columns in order."""
    names = names or (ID, *(c for c in df.columns if c != ID))
    columns = (F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in names)
    return df.select(F.lit(table).alias("table_name"), F.concat_ws("|", *columns).alias("row_text"))


def remap_sentinel(spark: SparkSession, folder: str) -> DataFrame:
    merge = merge_of(
        spark, folder, ("missed_call_logs",), ("jid", "chat", "message", "message_add_on", "call_log")
    )
    parts = [row_texts(t, merge.main_table(t)) for t in ("call_log", "message_add_on")]
    parts.append(row_texts("missed_call_logs", merge.minor_table("missed_call_logs")))
    return reduce(DataFrame.unionByName, parts)


def reject_not_null(spark: SparkSession, folder: str) -> DataFrame:
    specs = {**default_specs(), "message_link": TableSpec("message_link", not_null=("message_row_id",))}
    merge = merge_of(spark, folder, ("message_link",), NEEDS["message_link"], specs)
    merge.minor_table("message_link")
    return merge.rejected("message_link")


def reject_not_null_main(spark: SparkSession, folder: str) -> DataFrame:
    """Add-ons whose parent has no new id are refused before they take a key from an older copy."""
    specs = default_specs()
    specs["message_add_on"] = replace(specs["message_add_on"], not_null=("parent_message_row_id",))
    build = (*NEEDS["message_add_on"], "message_add_on")
    merge = merge_of(spark, folder, ("message_add_on",), build, specs)
    return merge.main_table("message_add_on")


def in_circle(spark: SparkSession, folder: str, further: dict[str, tuple[str, str]], **not_null: str) -> Merge:
    """A merge whose tables have further columns (name and SQL text) and NOT NULL columns that point in a circle."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    archives = []
    for path, of in zip(PATHS, snapshot_frames(Given(spark, folder), ["jid", "chat", "message", *not_null])):
        changed = {t: of[t].withColumn(column, F.expr(text)) for t, (column, text) in further.items()}
        archives.append(FrameArchive(path, {**of, **changed}))
    specs = default_specs()
    specs.update({t: replace(specs[t], not_null=(column,)) for t, column in not_null.items()})
    merge = Merge(spark, archives, specs, Staging(spark))
    merge.build_keys()
    return merge


def before(step: int) -> str:
    """The id of the row before, but at every `step`-th row its own."""
    return f"case when ((_id - 1) div 3) % {step} = 0 then _id else _id - 3 end"


def reject_not_null_self(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that must quote one, in chains of up to six; the first of a chain quotes itself."""
    column = "quoted_message_row_id"
    merge = in_circle(spark, folder, {"message": (column, before(6))}, message=column)
    return merge.main_table("message").select(ID, "key_id", "from_me", TIME, column)


def reject_not_null_circle(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that must have an add-on, and add-ons that must have a message."""
    columns = {"message": "first_message_add_on_row_id", "message_add_on": "parent_message_row_id"}
    merge = in_circle(spark, folder, {"message": (columns["message"], before(4))}, **columns)
    shown = (ID, "key_id", "from_me", TIME)
    parts = (merge.main_table(t).select(F.lit(t).alias("table_name"), *shown, F.col(c).alias("reference")) for t, c in columns.items())
    return reduce(DataFrame.unionByName, parts)


def minor_table_own_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A table whose ids are data, with its references looked up by broadcasts and by one shuffle."""
    parts = []
    for shuffled, limit in ((0, BROADCAST_BYTES), (1, 0)):
        merge = for_table(spark, folder, "order_notes", broadcast_bytes=limit)
        parts.append(merge.minor_table("order_notes").select("*", F.lit(shuffled).cast("int").alias("shuffled")))
    return reduce(DataFrame.unionByName, parts)


def minor_declared_key(spark: SparkSession, folder: str) -> DataFrame:
    """A minor table whose store declares a key over a mapped column."""
    specs = {**default_specs(), "message_link": TableSpec("message_link", unique=(("message_row_id", "link_index"),))}
    return merge_of(spark, folder, ("message_link",), NEEDS["message_link"], specs).minor_table("message_link")


def with_child(merge: Merge, parent: str, column: str) -> DataFrame:
    """A main table, and the column that points at it of a table of all references."""
    child = merge.minor_table("references_of_events")
    return row_texts(parent, merge.main_table(parent)).unionByName(row_texts("references_of_events", child, (ID, column)))


def unique_on_mapped_column(spark: SparkSession, folder: str) -> DataFrame:
    """A second key over a mapped column: one card of a message stays, and references to the others are lost."""
    specs = default_specs()
    specs["message_vcard"] = replace(specs["message_vcard"], unique=(("message_row_id",),))
    build = (*NEEDS["message_vcard"], "message_vcard")
    merge = merge_of(spark, folder, ("message_vcard", "references_of_events"), build, specs)
    return with_child(merge, "message_vcard", "message_vcard_row_id")


def reject_not_null_children(spark: SparkSession, folder: str) -> DataFrame:
    """Add-ons less those refused, and what points at them."""
    specs = default_specs()
    specs["message_add_on"] = replace(specs["message_add_on"], not_null=("parent_message_row_id",))
    build = (*NEEDS["message_add_on"], "message_add_on")
    merge = merge_of(spark, folder, ("message_add_on", "references_of_events"), build, specs)
    return with_child(merge, "message_add_on", "message_add_on_row_id")


def excluded_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables a merge leaves out by their names, and one that is merged all the same: the rows of what is merged."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    archives = []
    for path, of in zip(PATHS, snapshot_frames(Given(spark, folder), ["message", "jid", "chat"])):
        listed = of["jid"].select(ID, "raw_string")
        further = {t: listed for t in ("jid_FTS_content", "chat_View", "sqlite_sequence", "props", "jid_view", "named_jids")}
        archives.append(FrameArchive(path, {**of, **further}))
    merge = Merge(spark, archives, default_specs(), Staging(spark), include_tables=("jid_view",))
    merge.build_keys()
    done = merge.tables(merge.staging.write)
    parts = (df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows") for t, df in done.items() if t != "props")
    return reduce(DataFrame.unionByName, parts)


SQLITE_FILES = 8
SQLITE_TABLE = "create table message (_id integer primary key, key_id text, timestamp integer, price real, text_data text, picture blob, kind)"


def write_sqlite(folder: str):
    """Writes the rows a task gets as SQLite files of its own, one for each `s`, and gives their numbers of rows."""

    def run(batches):
        import os
        import sqlite3

        import pyarrow as pa

        open_files = {}
        for batch in batches:
            for s, *values in zip(*(c.to_pylist() for c in batch.columns)):
                if s not in open_files:
                    path = f"{folder}/{s}.{os.getpid()}.part"
                    if os.path.exists(path):
                        os.remove(path)
                    open_files[s] = [path, sqlite3.connect(path), 0]
                    open_files[s][1].execute(SQLITE_TABLE)
                open_files[s][1].execute("insert into message values (?, ?, ?, ?, ?, ?, ?)", (*values[:-1], int(values[-1]) if s % 2 else values[-1]))
                open_files[s][2] += 1
        for s, (path, connection, n) in open_files.items():
            connection.commit()
            connection.close()
            # A second run of a task puts the same file in place.
            os.replace(path, f"{folder}/{s}.db")
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([n], pa.int64())], names=["s", "n"])

    return run


def scan_sqlite_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as SQLite files written by tasks, read as snapshots of one archive: texts, numbers, blobs and a column of no type."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    orders = Given(spark, folder)["orders"].select(
        (F.col("o_orderkey") % SQLITE_FILES).cast("int").alias("s"),
        (F.col("o_orderkey").cast("long") * 1_000_003).alias(ID),
        F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("K"), F.col("o_orderkey").cast("string"))).alias("key_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias(TIME),
        F.col("o_totalprice").cast("double").alias("price"),
        F.col("o_orderpriority").alias("text_data"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority").cast("binary")).alias("picture"),
        F.col("o_custkey").cast("string").alias("kind"),
    )
    root = Staging(spark).root.removeprefix("file://")
    os.makedirs(root)
    orders.repartition(SQLITE_FILES, "s").mapInArrow(write_sqlite(root), "s int, n long").collect()
    archives = [(s, open_archive(spark, path)) for s in range(SQLITE_FILES) if os.path.exists(path := f"{root}/{s}.db")]
    wanted = ["key_id", TIME, "price", "text_data", "picture", "kind"]
    rows = read_union(spark, archives, "message", [ID, *wanted], lambda df, keep: df.select(*keep, ID, *wanted))
    kind = sqlite.stored(F.col("kind"))
    return rows.select(SNAPSHOT, ID, "key_id", TIME, "price", "text_data", F.hex("picture").alias("picture"), kind["class"].alias("kind_class"), kind["text"].alias("kind"))


def map_rank_zip_of(table: str, spark: SparkSession, folder: str) -> DataFrame:
    """The one-to-one map of a table, with one-to-one maps of all tables it points at."""
    build = dict.fromkeys(("jid", "chat", "message", *NEEDS[table], table))
    return merge_of(spark, folder, (table,), build, map_mode="rank_zip").maps[table].df


def tables_emptied(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a table that a merge empties, and of one that it doesn't."""
    merge = merge_of(spark, folder, ("backup_changes", "labels"), ("labels",))
    done = merge.tables(merge.staging.write)
    parts = (
        done[t].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t in ("backup_changes", "labels")
    )
    return reduce(DataFrame.unionByName, parts)


def scan_many_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as 40 stored snapshots, half of them in folders by value, read as one table."""
    orders = Given(spark, folder)["orders"].select(
        (F.col("o_orderkey") % 40).cast("int").alias("s"),
        F.col("o_orderkey").cast("long").alias(ID),
        F.col("o_orderpriority").alias("text_data"),
        (F.col("o_custkey") % 3).cast("int").alias("part"),
    )
    staging = Staging(spark)
    by_snapshot = staging.write("orders", orders.repartition("s"))
    archives = []
    for i in range(40):
        own = by_snapshot.where(F.col("s") == i).drop("s").coalesce(1)
        path = f"{staging.root}/snap {i}"
        writer = own.write.partitionBy("part") if i < 20 else own.drop("part").write
        writer.parquet(f"{path}/message")
        archives.append((i, ParquetArchive(spark, path)))
    base = T.StructType.fromDDL("_id bigint, text_data string, part int")
    return read_union(spark, archives, "message", base.names, lambda df, keep: align(df, base, keep=keep))


def chats(columns: tuple[str, ...], stale: str, spark: SparkSession, folder: str) -> DataFrame:
    merge = for_table(spark, folder, "message")
    refreshed = derive.refresh_chats(merge.main_table("chat"), merge.main_table("message"), stale)
    return refreshed.select(ID, *columns)


def top1(table: str, spark: SparkSession, folder: str) -> DataFrame:
    return minor_rows(table, spark, folder)


def props_reset(spark: SparkSession, folder: str) -> DataFrame:
    return merge_of(spark, folder, ("props",), ()).props()


def legacy_query(make, spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    frames = LegacyFrames(Given(spark, folder))
    return make(frames, Contacts.of(frames["jid"], frames["chat"]))


def convert_thumbnails(frames: LegacyFrames, contacts: Contacts) -> DataFrame:
    legacy.assert_one_thumbnail(frames["message_thumbnails"], frames["messages"])
    return legacy.thumbnails(frames["message_thumbnails"], frames["messages"])


def convert_quote_flag(frames: LegacyFrames, contacts: Contacts) -> DataFrame:
    quoted = legacy.quotes(frames["messages"], frames["messages_quotes"], contacts)
    messages = legacy.messages(frames["messages"], contacts).select(ID, F.lit(None).cast("int").alias("lookup_tables"))
    return derive.flag_quoting(messages, quoted)


def convert_links(frames: LegacyFrames, contacts: Contacts) -> DataFrame:
    assert_unique(frames["messages_links"], [ID], "message_link")
    return legacy.links(frames["messages_links"], contacts)


def convert_common_copy(frames: LegacyFrames, contacts: Contacts) -> DataFrame:
    return copy_common(frames["settings"], T.StructType.fromDDL("name string, _id bigint, added string"))


def schema_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Column names of each given table in one string, with its number of rows."""
    names = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
    given = Given(spark, folder)
    archive = FrameArchive("given", {t: given[t] for t in names})
    parts = (
        archive.read(t)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(t).alias("table_name"), F.lit(listing(archive.schema(t).names)).alias("columns"), "n_rows")
        for t in archive.tables()
    )
    return reduce(DataFrame.unionByName, parts)


def merge_archive_full(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of every table of the merged archive, that of an emptied one included."""
    names = (*MAIN, *MINOR, "backup_changes")
    merge = merge_of(spark, folder, (*names, "props"), MAIN)
    tables = merge.tables(merge.staging.write)
    parts = [row_texts(t, tables[t]) for t in names]
    parts.append(row_texts("props", tables["props"], ("key", "value")))
    return reduce(DataFrame.unionByName, parts)


def stored_snapshots(spark: SparkSession, folder: str, staging: Staging) -> list[str]:
    """The derived snapshots, written as Parquet archives."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    frames = zip(PATHS, snapshot_frames(Given(spark, folder), [*MAIN, *MINOR]))
    parts = [(f"{path}/{table}", df) for path, of in frames for table, df in of.items()]
    together(lambda part: staging.write(*part), parts)
    return [f"{staging.root}/{path}" for path in PATHS]


def merge_archives_published(spark: SparkSession, folder: str) -> DataFrame:
    """Stored snapshots merged into a stored archive, which is read back."""
    staging = Staging(spark)
    merge_archives(spark, stored_snapshots(spark, folder, staging), f"{staging.root}/out")
    written = ParquetArchive(spark, f"{staging.root}/out")
    return reduce(DataFrame.unionByName, (row_texts(t, written.read(t)) for t in (*MAIN, *MINOR)))


def incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The two newer snapshots are merged, then the oldest onto the stored result, which is the base."""
    staging = Staging(spark)
    oldest, *newer = stored_snapshots(spark, folder, staging)
    merge_archives(spark, newer, f"{staging.root}/newer")
    result = merge_archives(spark, [f"{staging.root}/newer", oldest], f"{staging.root}/all")
    return reduce(DataFrame.unionByName, (row_texts(t, result.tables[t]) for t in (*MAIN, *MINOR)))


def convert_archive_full(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of every table of the converted archive."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    given, names = LegacyFrames(Given(spark, folder)), LEGACY
    result = convert_archive(spark, FrameArchive("legacy", {t: given[t] for t in names}))
    return reduce(DataFrame.unionByName, (row_texts(t, result.tables[t], shown) for t, shown in CONVERTED.items()))


# Tables of the legacy archive, and what is shown of the converted ones.
LEGACY = (
    "jid", "chat", "messages", "messages_quotes", "messages_links", "messages_vcards", "messages_vcards_jids",
    "frequents", "message_thumbnails", "settings",
)
CONVERTED = {
    "jid": (ID, "raw_string"),
    "chat": (ID, "jid_row_id"),
    "settings": (ID, "name", "old_only"),
    "message_quoted": ("message_row_id", "chat_row_id", "from_me", "sender_jid_row_id", "key_id", TIME, "text_data"),
    "message": (ID, "chat_row_id", "sender_jid_row_id", "from_me", "text_data", "key_id", "lookup_tables"),
    "message_link": (ID, "chat_row_id", "message_row_id", "link_index"),
    "message_vcard": (ID, "message_row_id", "vcard"),
    "message_vcard_jid": (ID, "vcard_jid_row_id", "vcard_row_id", "message_row_id"),
    "frequent": (ID, "jid_row_id", "type", "message_count"),
    "message_thumbnail": ("message_row_id", "thumbnail"),
}


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "merge_messages_latest": merge_messages_latest,
        "scan_snapshots_union": scan_snapshots_union,
        "align_common_columns": align_common_columns,
        "source_validation": source_validation,
        "rank_snapshots": rank_query,
        "reid_messages": reid_messages,
        "map_rank_zip": map_rank_zip,
        "remap_message_children": partial(minor_rows, "message_link"),
        "remap_every_rule": partial(minor_rows, "references_of_events"),
        "remap_sentinel": remap_sentinel,
        "remap_chat_exception": partial(main_rows, "chat"),
        "minor_bag_union": partial(minor_rows, "missed_call_logs"),
        "reject_not_null": reject_not_null,
        "chat_pointers": partial(
            chats, ("display_message_row_id", "last_read_message_sort_id", "ephemeral_message_row_id"), "keep"
        ),
        "chat_pointers_cleared": partial(
            chats, ("display_message_row_id", "last_read_message_sort_id", "ephemeral_message_row_id"), "null"
        ),
        "chat_hidden": partial(chats, ("hidden",), "keep"),
        "chat_reaction_reset": partial(
            chats, ("last_message_reaction_row_id", "last_seen_message_reaction_row_id"), "keep"
        ),
        "chat_sort_timestamp": partial(chats, ("hidden", "sort_timestamp"), "keep"),
        "frequent_top1": partial(top1, "frequent"),
        "frequents_top1": partial(top1, "frequents"),
        "props_reset": props_reset,
        "convert_messages": partial(legacy_query, lambda f, c: legacy.messages(f["messages"], c)),
        "convert_links": partial(legacy_query, convert_links),
        "convert_quotes": partial(legacy_query, lambda f, c: legacy.quotes(f["messages"], f["messages_quotes"], c)),
        "convert_vcards": partial(legacy_query, lambda f, c: legacy.vcards(f["messages_vcards"])),
        "convert_vcard_jids": partial(legacy_query, lambda f, c: legacy.vcard_jids(f["messages_vcards_jids"], c)),
        "convert_frequents": partial(legacy_query, lambda f, c: legacy.frequents(f["frequents"], c)),
        "convert_thumbnails": partial(legacy_query, convert_thumbnails),
        "convert_quote_flag": partial(legacy_query, convert_quote_flag),
        "convert_common_copy": partial(legacy_query, convert_common_copy),
        "schema_listing": schema_listing,
        "incremental_merge": incremental_merge,
        "merge_archive_full": merge_archive_full,
        "merge_archives_published": merge_archives_published,
        "scan_many_snapshots": scan_many_snapshots,
        "tables_emptied": tables_emptied,
        "reject_not_null_main": reject_not_null_main,
        "reject_not_null_children": reject_not_null_children,
        "reject_not_null_self": reject_not_null_self,
        "reject_not_null_circle": reject_not_null_circle,
        "unique_on_mapped_column": unique_on_mapped_column,
        "minor_table_own_ids": minor_table_own_ids,
        "minor_declared_key": minor_declared_key,
        "excluded_tables": excluded_tables,
        "scan_sqlite_files": scan_sqlite_files,
        "convert_archive_full": convert_archive_full,
    }
    short = {
        "message_add_on": "add_on",
        "message_vcard": "vcard",
        "group_participant_user": "group_participant",
    }
    for t in MAIN:
        found[f"dedupe_{short.get(t, t)}"] = partial(dedupe, t)
        found[f"map_{short.get(t, t)}"] = partial(id_map, t)
    for t in ("call_log", "message_add_on", "message_vcard", "reporting_info"):
        found[f"map_rank_zip_{short.get(t, t)}"] = partial(map_rank_zip_of, t)
    return found

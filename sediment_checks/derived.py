"""Snapshots derived from the given tables by SQL text that both engines read alike.

Three snapshots reach further and further in time and each lacks some rows the others have. Every
surrogate id is private to its snapshot. `{orders}` and the like stand for the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sediment.staging import Staging

# Snapshot number, end of its orders, end of its events, last digit of the keys it lacks; the last one lacks
# only such keys as the one before it may have, so every given row is in some snapshot.
SNAPSHOTS = (
    (0, "1998-07-01", "2024-01-11", 0),
    (1, "2000-07-01", "2024-01-21", 4),
    (2, "2999-01-01", "2999-01-01", 8),
)
GIVEN = ("customer", "orders", "lineitem", "events", "nation", "part")
PATHS = tuple(f"snapshot_{s}" for s, *_ in SNAPSHOTS)


def spark_millis(column: str) -> str:
    return f"unix_millis(cast({column} as timestamp))"


def duck_millis(column: str) -> str:
    return f"(epoch_us({column}) // 1000)"


def key_of(column: str, step: int) -> str:
    return f"cast(cast(floor({column} / {step}) as bigint) as varchar(20))"


def own(column: str, s: int) -> str:
    """An id private to snapshot s."""
    return f"cast({column} * 3 + {s} + 1 as bigint)"


# Lines of an order with their numbers, which are the same in every snapshot, as a snapshot lacks orders as a whole.
NUMBERED = """
        select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
               l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) as n
        from {lineitem}"""
LINES = "numbered_lines"


def snapshot_tables(
    s: int, order_cut: str, event_cut: str, hole: int, millis: Callable[[str], str], numbered: str = NUMBERED
) -> dict[str, str]:
    """SQL text of each table; `numbered` gives the numbered lines, up to its `where`."""
    _, orders_before, events_before, _ = SNAPSHOTS[max(s - 1, 0)]
    own_orders = f" or o_orderdate >= timestamp '{orders_before} 00:00:00'" if s == SNAPSHOTS[-1][0] else ""
    own_events = f" or ts >= timestamp '{events_before} 00:00:00'" if s == SNAPSHOTS[-1][0] else ""
    orders_kept = f"o_orderdate < timestamp '{order_cut} 00:00:00' and (o_orderkey % 10 <> {hole}{own_orders})"
    events_kept = f"ts < timestamp '{event_cut} 00:00:00' and (event_id % 10 <> {hole}{own_events})"
    lines = f"{numbered} where l_orderkey % 10 <> {hole}"
    counted = f"""
        select user_id, event_type, count(*) as n from {{events}} where {events_kept} group by user_id, event_type"""
    type_code = "case event_type when 'click' then 0 when 'view' then 1 when 'error' then 2 when 'signup' then 3 else 4 end"
    chat_of_order = f"cast((o_custkey * 3 + {s} + 1) * 2 as bigint)"
    chat_of_user = f"cast((user_id * 3 + {s} + 1) * 2 as bigint)"
    return {
        "jid": f"""
            select {own('c_custkey', s)} as _id, c_name as raw_string, cast({s} as int) as seen_in
            from {{customer}} where c_custkey % 6 <> {s}""",
        "chat": f"""
            select cast((c_custkey * 3 + {s} + 1) * 2 as bigint) as _id, {own('c_custkey', s)} as jid_row_id,
                   cast(1 as int) as hidden, cast(c_custkey as bigint) as sort_timestamp,
                   cast(c_custkey + 7000000 as bigint) as display_message_row_id,
                   cast(c_custkey + 8000000 as bigint) as last_read_message_sort_id,
                   cast(c_custkey + 9000000 as bigint) as ephemeral_message_row_id,
                   cast(c_custkey as bigint) as last_message_reaction_row_id,
                   cast(c_custkey as bigint) as last_seen_message_reaction_row_id,
                   c_mktsegment as subject
            from {{customer}} where c_custkey % 6 <> {s} and (c_custkey * 3 + {s} + 1) % 11 <> 0""",
        "message": f"""
            select {own('o_orderkey', s)} as _id, {chat_of_order} as chat_row_id,
                   cast(o_orderkey % 2 as int) as from_me, 'K' || {key_of('o_orderkey', 2)} as key_id,
                   case when o_orderkey % 2 = 1 then null else {own('o_custkey', s)} end as sender_jid_row_id,
                   case when o_orderkey % 97 = 0 then null else {millis('o_orderdate')} end as timestamp,
                   cast(case o_orderstatus when 'F' then 0 when 'O' then 1 else 7 end as int) as message_type,
                   case when o_orderkey % 7 = 0 then null else o_orderpriority end as text_data,
                   cast(0 as bigint) as sort_id, cast({s} as int) as status
            from {{orders}} where {orders_kept}""",
        "message_add_on": f"""
            select {own('event_id', s)} as _id, {chat_of_user} as chat_row_id, cast(event_id % 2 as int) as from_me,
                   'E' || {key_of('event_id', 2)} as key_id,
                   case when event_id % 2 = 1 then null else {own('user_id', s)} end as sender_jid_row_id,
                   case when event_id % 97 = 0 then null else {millis('ts')} end as timestamp,
                   {own('event_id', s)} as parent_message_row_id
            from {{events}} where {events_kept} and event_type in ('view', 'error')""",
        "call_log": f"""
            select {own('event_id', s)} as _id, 'C' || {key_of('event_id', 3)} as call_id,
                   cast(event_id % 2 as int) as from_me, {own('user_id', s)} as jid_row_id,
                   case when event_id % 5 = 0 then null else cast(-1 as bigint) end as transaction_id,
                   case when event_id % 97 = 0 then null else {millis('ts')} end as timestamp
            from {{events}} where {events_kept} and event_type not in ('view', 'error')""",
        "quick_replies": f"""
            select {own('p_partkey', s)} as _id, p_name as title from {{part}} where p_partkey % 6 <> {s}""",
        "message_vcard": f"""
            select cast((l_orderkey * 10000 + n) * 3 + {s} + 1 as bigint) as _id,
                   {own('l_orderkey', s)} as message_row_id, 'V' || cast(l_linenumber as varchar(20)) as vcard
            from ({lines}) as lines""",
        "group_participant_user": f"""
            select {own('c_custkey', s)} as _id, {own('(c_custkey % 50)', s)} as group_jid_row_id,
                   {own('c_custkey', s)} as user_jid_row_id
            from {{customer}} where c_custkey % 5 <> {s}""",
        "labels": f"""
            select {own('n_nationkey', s)} as _id, 'L' || cast(n_nationkey % 10 as varchar(20)) as label_name
            from {{nation}} where n_nationkey % 6 <> {s}""",
        "reporting_info": f"""
            select {own('o_orderkey', s)} as _id, {own('o_orderkey', s)} as message_row_id,
                   o_orderpriority as reporting_tag, 'S' || {key_of('o_orderkey', 3)} as stanza_id
            from {{orders}} where {orders_kept} and o_orderkey % 5 = 0""",
        "message_link": f"""
            select cast((l_orderkey * 10000 + n) * 3 + {s} + 1 as bigint) as _id,
                   {own('l_orderkey', s)} as message_row_id, cast(l_linenumber as int) as link_index
            from ({lines}) as lines""",
        "frequent": f"""
            select cast((user_id * 5 + {type_code}) * 3 + {s} + 1 as bigint) as _id, {own('user_id', s)} as jid_row_id,
                   cast({type_code} as int) as type, cast(n as bigint) as message_count
            from ({counted}) as counted""",
        "frequents": f"""
            select cast((user_id * 5 + {type_code}) * 3 + {s} + 1 as bigint) as _id,
                   case when user_id % 9 = 0 then null else 'U' || cast(user_id as varchar(20)) end as jid,
                   cast({type_code} as int) as type, cast(n as bigint) as message_count
            from ({counted}) as counted""",
        "missed_call_logs": f"""
            select {own('event_id', s)} as _id, {own('user_id', s)} as jid_row_id
            from {{events}} where {events_kept}""",
        "references_of_events": f"""
            select {own('event_id', s)} as _id, {own('user_id', s)} as vcard_jid_row_id,
                   {own('user_id', s)} as seller_jid, {own('user_id', s)} as participant_lid_row_id,
                   {chat_of_user} as parent_message_chat_row_id, {own('event_id', s)} as message_row_id,
                   {own('event_id', s)} as message_table_id, {own('event_id', s)} as call_log_row_id,
                   {own('event_id', s)} as message_add_on_row_id,
                   cast((event_id * 10000 + 1) * 3 + {s} + 1 as bigint) as message_vcard_row_id,
                   {own('(event_id % 200)', s)} as quick_reply_id, {own('event_id', s)} as reporting_info_row_id,
                   {own('(event_id % 25)', s)} as label_id, {own('user_id', s)} as group_participant_user_row_id,
                   cast(event_id as bigint) as call_link_row_id
            from {{events}} where {events_kept}""",
        # Its _id is no surrogate: it is not the first column, repeats and is missing.
        "order_notes": f"""
            select 'N' || {key_of('o_orderkey', 4)} as note,
                   case when o_orderkey % 7 = 0 then null else cast(o_orderkey % 50 as bigint) end as _id,
                   {chat_of_order} as chat_row_id, {own('o_orderkey', s)} as message_row_id
            from {{orders}} where {orders_kept}""",
        "props": f"""
            select case when c_custkey = 1 then 'fts_index_start' when c_custkey % 50 = 2 then 'fts_ready'
                        when c_custkey % 50 = 3 then null else 'P' || cast(c_custkey as varchar(20)) end as key,
                   cast(c_custkey * 3 + {s} as varchar(20)) as value
            from {{customer}}""",
        "backup_changes": f"""
            select {own('n_nationkey', s)} as _id from {{nation}}""",
    }


def legacy_tables(millis: Callable[[str], str]) -> dict[str, str]:
    """One legacy archive. Contacts of customers divisible by 6 are unknown, and some known ones have no chat."""
    contact = "'Customer#' || lpad(cast({} as varchar(20)), 9, '0')".format
    quoted = "cast(floor(o_orderkey / 4) * 8 as bigint)"
    return {
        "jid": "select cast(c_custkey + 1 as bigint) as _id, c_name as raw_string from {customer} where c_custkey % 6 <> 0",
        "chat": """
            select cast(c_custkey * 2 + 2 as bigint) as _id, cast(c_custkey + 1 as bigint) as jid_row_id
            from {customer} where c_custkey % 11 <> 0""",
        "messages": f"""
            select cast(o_orderkey + 1 as bigint) as _id, {contact('o_custkey')} as key_remote_jid,
                   cast(o_orderkey % 2 as int) as key_from_me, 'K' || {key_of('o_orderkey', 2)} as key_id,
                   case when o_orderkey % 2 = 1 then null else {contact('o_custkey + o_orderkey % 3')} end as remote_resource,
                   case when o_orderkey % 7 = 0 then null else o_orderpriority end as data,
                   cast(o_orderkey % 5 as int) as status, cast(0 as int) as recipient_count,
                   cast(null as varchar(20)) as participant_hash, cast(o_orderkey % 3 as int) as origin,
                   {millis('o_orderdate')} as timestamp, {millis('o_orderdate')} + 1 as received_timestamp,
                   cast(case o_orderstatus when 'F' then 0 when 'O' then 1 else 7 end as int) as media_wa_type,
                   cast(-1 as bigint) as receipt_server_timestamp, cast(o_orderkey % 13 as int) as starred,
                   case when o_orderkey % 4 = 0 then {quoted} + 1
                        when o_orderkey % 3 = 0 then cast(0 as bigint) else null end as quoted_row_id
            from {{orders}}""",
        "messages_quotes": f"""
            select cast(o_orderkey + 1 as bigint) as _id, {contact('o_custkey')} as key_remote_jid,
                   cast(o_orderkey % 2 as int) as key_from_me, 'K' || {key_of('o_orderkey', 2)} as key_id,
                   case when o_orderkey % 2 = 1 then null else {contact('o_custkey')} end as remote_resource,
                   {millis('o_orderdate')} as timestamp, cast(0 as int) as media_wa_type,
                   cast(o_orderkey % 3 as int) as origin, o_orderpriority as data,
                   case when o_orderkey % 64 = 0 then 'T' || cast(o_orderkey as varchar(20)) else null end
                       as payment_transaction_id
            from {{orders}} where o_orderkey % 8 = 0""",
        "messages_links": f"""
            select cast(o_orderkey + 1 as bigint) as _id, {contact('o_custkey')} as key_remote_jid,
                   cast(o_orderkey + 1 as bigint) as message_row_id, cast(o_orderkey % 3 as int) as link_index
            from {{orders}} where o_orderkey % 4 <> 1""",
        "messages_vcards": """
            select cast(l_orderkey * 10000 + row_number() over (partition by l_orderkey order by l_linenumber, l_partkey,
                        l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) as bigint) as _id,
                   cast(l_orderkey + 1 as bigint) as message_row_id, 'V' || cast(l_linenumber as varchar(20)) as vcard
            from {lineitem}""",
        "messages_vcards_jids": f"""
            select cast(o_orderkey + 1 as bigint) as _id, {contact('o_custkey')} as vcard_jid,
                   cast(o_orderkey * 10000 + 1 as bigint) as vcard_row_id,
                   cast(o_orderkey + 1 as bigint) as message_row_id
            from {{orders}}""",
        "frequents": f"""
            select cast(user_id * 10 + n as bigint) as _id, {contact('user_id')} as jid, cast(n as int) as type,
                   cast(total as bigint) as message_count
            from (select user_id, length(event_type) as n, count(*) as total from {{events}}
                  group by user_id, length(event_type)) as counted""",
        "message_thumbnails": """
            select 'K' || cast(p_partkey as varchar(20)) as key_id, p_name as thumbnail from {part} where p_partkey % 3 <> 0""",
        "settings": "select cast(n_nationkey as bigint) as _id, n_name as name, cast(n_regionkey as int) as old_only from {nation}",
    }


class Given:
    """The given tables of one folder, and frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.known: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self.known:
            if table == LINES:
                # Numbered and written once: a merge reads the tables made of them several times in each of three snapshots.
                self.known[table] = Staging(self.spark).write(LINES, self.frame(NUMBERED))
            else:
                self.known[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self.known[table]

    def frame(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{t: self[t] for t in (*GIVEN, LINES) if f"{{{t}}}" in text})


def snapshot_frames(given: Given, tables: list[str]) -> list[dict[str, DataFrame]]:
    """The wanted tables of each snapshot."""
    numbered = f"select l_orderkey, l_linenumber, n from {{{LINES}}}"
    texts = [snapshot_tables(*params, spark_millis, numbered) for params in SNAPSHOTS]
    return [{t: given.frame(text[t]) for t in tables} for text in texts]


class LegacyFrames:
    """The legacy archive's tables, made when they are asked for."""

    def __init__(self, given: Given):
        self.given, self.texts = given, legacy_tables(spark_millis)

    def __getitem__(self, table: str) -> DataFrame:
        return self.given.frame(self.texts[table])

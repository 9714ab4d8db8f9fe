"""The registered queries in plain SQL, written with whole-table windows and joins."""

from __future__ import annotations

import re

from sediment_checks.derived import GIVEN, PATHS, SNAPSHOTS, duck_millis, legacy_tables, snapshot_tables

TIMED = ("message", "call_log", "message_add_on")
MESSAGE_KEY = ("chat_row_id", "from_me", "key_id", "sender_jid_row_id")
KEYS = {
    "jid": ("raw_string",),
    "chat": ("jid_row_id",),
    "message": MESSAGE_KEY,
    "message_add_on": MESSAGE_KEY,
    "call_log": ("call_id", "from_me", "jid_row_id", "transaction_id"),
    "quick_replies": ("title",),
    "message_vcard": ("message_row_id", "vcard"),
    "group_participant_user": ("group_jid_row_id", "user_jid_row_id"),
    "labels": ("label_name",),
    "reporting_info": ("reporting_tag", "stanza_id"),
}
MAP_KEYS = {
    **KEYS,
    "message": ("key_id", "from_me"),
    "message_add_on": ("key_id", "from_me"),
    "call_log": ("call_id",),
    "message_vcard": ("message_row_id",),
    "reporting_info": ("message_row_id",),
}
# Parts of the looser keys: column, and the parent table and column it stands for, if any.
WEAK_KEYS = {
    "jid": (("raw_string", None, None),),
    "chat": (("jid_row_id", "jid", "raw_string"),),
    "message": (("key_id", None, None), ("from_me", None, None)),
    "message_add_on": (("key_id", None, None), ("from_me", None, None)),
    "call_log": (("call_id", None, None),),
    "quick_replies": (("title", None, None),),
    "message_vcard": (("message_row_id", "message", "key_id"),),
    "group_participant_user": (("group_jid_row_id", "jid", "raw_string"), ("user_jid_row_id", "jid", "raw_string")),
    "labels": (("label_name", None, None),),
    "reporting_info": (("message_row_id", None, None),),
}
# Column: (target, whether an unknown reference is 0).
REFERENCES = {
    "chat": {"jid_row_id": ("jid", False)},
    "message": {"chat_row_id": ("chat", False), "sender_jid_row_id": ("jid", True)},
    "message_add_on": {
        "chat_row_id": ("chat", False),
        "sender_jid_row_id": ("jid", False),
        "parent_message_row_id": ("message", False),
    },
    "call_log": {"jid_row_id": ("jid", True)},
    "message_vcard": {"message_row_id": ("message", False)},
    "group_participant_user": {"group_jid_row_id": ("jid", False), "user_jid_row_id": ("jid", False)},
    "reporting_info": {"message_row_id": ("message", False)},
    "message_link": {"message_row_id": ("message", False)},
    "frequent": {"jid_row_id": ("jid", False)},
    "missed_call_logs": {"jid_row_id": ("jid", True)},
    "references_of_events": {
        "vcard_jid_row_id": ("jid", False),
        "seller_jid": ("jid", False),
        "participant_lid_row_id": ("jid", False),
        "parent_message_chat_row_id": ("chat", False),
        "message_row_id": ("message", False),
        "message_table_id": ("message", False),
        "call_log_row_id": ("call_log", False),
        "message_add_on_row_id": ("message_add_on", False),
        "message_vcard_row_id": ("message_vcard", False),
        "quick_reply_id": ("quick_replies", False),
        "reporting_info_row_id": ("reporting_info", False),
        "label_id": ("labels", False),
        "group_participant_user_row_id": ("group_participant_user", False),
    },
}
COLUMNS = {
    "jid": ("raw_string", "seen_in"),
    "chat": (
        "jid_row_id", "hidden", "sort_timestamp", "display_message_row_id", "last_read_message_sort_id",
        "ephemeral_message_row_id", "last_message_reaction_row_id", "last_seen_message_reaction_row_id", "subject",
    ),
    "message": (
        "chat_row_id", "from_me", "key_id", "sender_jid_row_id", "timestamp", "message_type", "text_data", "sort_id",
        "status",
    ),
    "message_add_on": ("chat_row_id", "from_me", "key_id", "sender_jid_row_id", "timestamp", "parent_message_row_id"),
    "call_log": ("call_id", "from_me", "jid_row_id", "transaction_id", "timestamp"),
    "quick_replies": ("title",),
    "message_vcard": ("message_row_id", "vcard"),
    "group_participant_user": ("group_jid_row_id", "user_jid_row_id"),
    "labels": ("label_name",),
    "reporting_info": ("message_row_id", "reporting_tag", "stanza_id"),
    "message_link": ("message_row_id", "link_index"),
    "frequent": ("jid_row_id", "type", "message_count"),
    "frequents": ("jid", "type", "message_count"),
    "missed_call_logs": ("jid_row_id",),
    "references_of_events": (*REFERENCES["references_of_events"], "call_link_row_id"),
}
FREQUENT = {"frequent": "jid_row_id", "frequents": "jid"}
MAIN = tuple(KEYS)
MINOR = tuple(t for t in COLUMNS if t not in KEYS)


def all_of(template: str, names, joiner: str = " and ") -> str:
    return joiner.join(template.format(n) for n in names)


def building_blocks() -> dict[str, str]:
    """Common table expressions by name; `statement` picks those a query needs."""
    given = {t: t for t in GIVEN}
    texts = {s: snapshot_tables(s, *rest, duck_millis) for s, *rest in SNAPSHOTS}
    blocks = {
        "ranks": "select snapshot_id, row_number() over (order by max(timestamp) desc, snapshot_id) as merge_rank"
        " from d_message group by snapshot_id"
    }
    for t in (*COLUMNS, "props", "order_notes"):
        parts = (f"select {s} as snapshot_id, q.* from ({texts[s][t].format(**given)}) as q" for s, *_ in SNAPSHOTS)
        blocks[f"d_{t}"] = " union all ".join(parts)
    for t in COLUMNS:
        references = REFERENCES.get(t, {})
        picked, joins = [], []
        for n, c in enumerate(COLUMNS[t]):
            if c in references:
                target, zero = references[c]
                picked.append(f"coalesce(a{n}.new_id, 0) as {c}" if zero else f"a{n}.new_id as {c}")
                joins.append(f"left join m_{target} a{n} on a{n}.snapshot_id = d.snapshot_id and a{n}.old_id = d.{c}")
            else:
                picked.append(f"d.{c}")
        # r_: references rewritten.
        blocks[f"r_{t}"] = (
            f"select d.snapshot_id, k.merge_rank, d._id, {', '.join(picked)} from d_{t} d"
            f" join ranks k on k.snapshot_id = d.snapshot_id {' '.join(joins)}"
        )
    for t in MAIN:
        key, timed = KEYS[t], t in TIMED
        within = "merge_rank, timestamp, _id" if timed else "merge_rank, _id"
        order = "timestamp, merge_rank, _id" if timed else "merge_rank, _id"
        # s_: survivors with their new ids.
        blocks[f"s_{t}"] = (
            f"select * exclude (rn), row_number() over (order by {order}) as new_id from (select *, row_number() over"
            f" (partition by {', '.join(key)} order by {within}) as rn from r_{t}"
            f"{' where timestamp is not null' if timed else ''}) as q where rn = 1 or {all_of('{} is null', key, ' or ')}"
        )
        referable = all_of("{} is not null", MAP_KEYS[t])
        # m_: old id to new id.
        blocks[f"m_{t}"] = (
            f"select r.snapshot_id, r._id as old_id, s.new_id from r_{t} r join s_{t} s on {all_of('r.{0} = s.{0}', key)}"
            f" where {all_of('r.{} is not null', MAP_KEYS[t])} union all select snapshot_id, _id, new_id from s_{t}"
            f" where ({all_of('{} is null', key, ' or ')}) and {referable}"
        )
        blocks[f"t_{t}"] = f"select new_id as _id, {', '.join(COLUMNS[t])} from s_{t}"
    blocks["t_message"] = "select new_id as _id, * exclude (new_id, _id, sort_id, merge_rank, snapshot_id), new_id as sort_id from s_message"
    for t in MINOR:
        source = f"r_{t}"
        if t in FREQUENT:
            source = (
                f"(select * from (select *, row_number() over (partition by {FREQUENT[t]} order by message_count desc"
                f" nulls last, merge_rank, _id) as top from r_{t}) as q where top = 1)"
            )
        blocks[f"t_{t}"] = (
            f"select row_number() over (order by merge_rank, _id) as _id, {', '.join(COLUMNS[t])} from {source} as q"
        )
    blocks["activity"] = (
        "select chat_row_id, max(case when message_type not in (0, 7) or (message_type = 0 and text_data is not null)"
        " then _id end) as last_id, max(case when message_type <> 7 then timestamp end) as latest,"
        " count(case when message_type <> 7 then 1 end) as n from t_message group by chat_row_id"
    )
    for name, stale in (("kept", "c.{0}"), ("cleared", "null")):
        pointers = ", ".join(
            f"cast(coalesce(a.last_id, {stale.format(p)}) as bigint) as {p}"
            for p in ("display_message_row_id", "last_read_message_sort_id")
        )
        blocks[f"chat_{name}"] = (
            "select c._id, c.jid_row_id, cast(case when a.n > 0 then 0 else 1 end as int) as hidden,"
            f" case when a.n > 0 then a.latest else c.sort_timestamp end as sort_timestamp, {pointers},"
            " c.ephemeral_message_row_id, cast(null as bigint) as last_message_reaction_row_id,"
            " cast(null as bigint) as last_seen_message_reaction_row_id, c.subject"
            " from t_chat c left join activity a on a.chat_row_id = c._id"
        )
    # y: the same with one-to-one maps throughout.
    for t in MAIN:
        key, timed, references = KEYS[t], t in TIMED, REFERENCES.get(t, {})
        within = "merge_rank, timestamp, _id" if timed else "merge_rank, _id"
        picked, joins, value = [], [], {}
        for n, c in enumerate(COLUMNS[t]):
            value[c] = f"d.{c}"
            if c in references:
                target, zero = references[c]
                value[c] = f"coalesce(a{n}.new_id, 0)" if zero else f"a{n}.new_id"
                joins.append(f"left join ym_{target} a{n} on a{n}.snapshot_id = d.snapshot_id and a{n}.old_id = d.{c}")
            picked.append(f"{value[c]} as {c}")
        for n, (c, parent, parent_column) in enumerate(WEAK_KEYS[t]):
            if parent:
                joins.append(f"left join d_{parent} p{n} on p{n}.snapshot_id = d.snapshot_id and p{n}._id = d.{c}")
                picked.append(f"p{n}.{parent_column} as w{n}, {value[c]} as v{n}")
            else:
                picked.append(f"{value[c]} as w{n}, {value[c]} as v{n}")
        blocks[f"yr_{t}"] = (
            f"select d.snapshot_id, k.merge_rank, d._id, {', '.join(picked)} from d_{t} d"
            f" join ranks k on k.snapshot_id = d.snapshot_id {' '.join(joins)}"
        )
        order = "timestamp, merge_rank, _id" if timed else "merge_rank, _id"
        blocks[f"ys_{t}"] = (
            f"select * exclude (rn), row_number() over (order by {order}) as new_id from (select *, row_number() over"
            f" (partition by {', '.join(key)} order by {within}) as rn from yr_{t}"
            f"{' where timestamp is not null' if timed else ''}) as q where rn = 1 or {all_of('{} is null', key, ' or ')}"
        )
        weak = [f"w{n}" for n in range(len(WEAK_KEYS[t]))]
        known = all_of("{} is not null", weak)
        found = all_of("v{} is not null", range(len(weak)))
        blocks[f"ym_{t}"] = (
            f"select r.snapshot_id, r._id as old_id, s.new_id from (select *, row_number() over (partition by snapshot_id,"
            f" {', '.join(weak)} order by _id) as rn from yr_{t} where {known}) r join (select *, row_number() over"
            f" (partition by {', '.join(weak)} order by {within}) as rn from ys_{t} where {known} and {found}) s"
            f" on {all_of('r.{0} = s.{0}', [*weak, 'rn'])} where s.merge_rank <= r.merge_rank"
        )
    # z_: one-to-one maps on (key_id, from_me); ranks within a key, on both sides.
    blocks["z_rows"] = (
        "select snapshot_id, merge_rank, _id, key_id, from_me, row_number() over (partition by snapshot_id, key_id,"
        " from_me order by _id) as rn from r_message where key_id is not null and from_me is not null"
    )
    blocks["z_targets"] = (
        "select merge_rank, new_id, key_id, from_me, row_number() over (partition by key_id, from_me"
        " order by merge_rank, timestamp, _id) as rn from s_message where key_id is not null and from_me is not null"
    )
    for t, text in legacy_tables(duck_millis).items():
        blocks[f"l_{t}"] = text.format(**given)
    blocks["l_contact"] = (
        "select j.raw_string, c._id as chat_id from l_jid j join l_chat c on c.jid_row_id = j._id"
    )
    blocks["c_quotes"] = (
        "select m._id as message_row_id, c.chat_id as chat_row_id, c.chat_id as parent_message_chat_row_id,"
        " q.key_from_me as from_me, coalesce(j._id, 0) as sender_jid_row_id, q.key_id, q.timestamp,"
        " q.media_wa_type as message_type, q.origin, q.data as text_data, q.payment_transaction_id,"
        " cast(0 as int) as lookup_tables from l_messages m join l_messages_quotes q on q._id = m.quoted_row_id"
        " join l_contact c on c.raw_string = q.key_remote_jid left join l_jid j on j.raw_string = q.remote_resource"
        " where m.quoted_row_id is not null and m.quoted_row_id <> 0"
    )
    blocks["c_messages"] = (
        "select m._id, c.chat_id as chat_row_id, coalesce(j._id, 0) as sender_jid_row_id, m.key_from_me as from_me,"
        " m.data as text_data, m.key_id, m.status, m.recipient_count, m.participant_hash, m.origin, m.timestamp,"
        " m.received_timestamp, m.media_wa_type as message_type, cast(0 as int) as broadcast,"
        " m.receipt_server_timestamp, m.starred, m._id as sort_id from l_messages m"
        " join l_contact c on c.raw_string = m.key_remote_jid left join l_jid j on j.raw_string = m.remote_resource"
    )
    blocks["c_flagged"] = (
        "select *, cast(case when _id in (select message_row_id from c_quotes) then 2 end as int) as lookup_tables"
        " from c_messages"
    )
    blocks["c_links"] = (
        "select l._id, c.chat_id as chat_row_id, l.message_row_id, l.link_index"
        " from l_messages_links l join l_contact c on c.raw_string = l.key_remote_jid"
    )
    blocks["c_vcard_jids"] = (
        "select v._id, j._id as vcard_jid_row_id, v.vcard_row_id, v.message_row_id"
        " from l_messages_vcards_jids v join l_jid j on j.raw_string = v.vcard_jid"
    )
    blocks["c_frequents"] = (
        "select f._id, j._id as jid_row_id, f.type, f.message_count from l_frequents f join l_jid j on j.raw_string = f.jid"
    )
    blocks["c_thumbnails"] = (
        "select m._id as message_row_id, t.thumbnail from l_message_thumbnails t join l_messages m on m.key_id = t.key_id"
    )
    return blocks


BLOCKS = building_blocks()
_NAME = re.compile(r"\b[a-z]{1,8}_?[a-z_]*\b")


def statement(final: str) -> str:
    """`final` with the common table expressions it needs, in order."""
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in BLOCKS and name not in needed:
                visit(BLOCKS[name])
                needed[name] = BLOCKS[name]

    visit(final)
    parts = [f"{name} as materialized ({body})" for name, body in needed.items()]
    return f"with {', '.join(parts)} {final}" if parts else final


def row_text(table: str, source: str, columns) -> str:
    joined = " || '|' || ".join(f"coalesce(cast({c} as varchar), '~')" for c in columns)
    return f"select '{table}' as table_name, {joined} as row_text from {source}"


def whole_archive(tables) -> str:
    parts = []
    for t in tables:
        source = "chat_cleared" if t == "chat" else f"t_{t}"
        parts.append(row_text(t, source, ("_id", *COLUMNS[t])))
    return " union all ".join(parts)


# Columns of the converted tables, in order.
CONVERTED = {
    "jid": ("l_jid", ("_id", "raw_string")),
    "chat": ("l_chat", ("_id", "jid_row_id")),
    "settings": ("l_settings", ("_id", "name", "old_only")),
    "message_quoted": (
        "c_quotes",
        ("message_row_id", "chat_row_id", "from_me", "sender_jid_row_id", "key_id", "timestamp", "text_data"),
    ),
    "message": ("c_flagged", ("_id", "chat_row_id", "sender_jid_row_id", "from_me", "text_data", "key_id", "lookup_tables")),
    "message_link": ("c_links", ("_id", "chat_row_id", "message_row_id", "link_index")),
    "message_vcard": ("l_messages_vcards", ("_id", "message_row_id", "vcard")),
    "message_vcard_jid": ("c_vcard_jids", ("_id", "vcard_jid_row_id", "vcard_row_id", "message_row_id")),
    "frequent": ("c_frequents", ("_id", "jid_row_id", "type", "message_count")),
    "message_thumbnail": ("c_thumbnails", ("message_row_id", "thumbnail")),
}


def converted_archive() -> str:
    return " union all ".join(row_text(t, source, columns) for t, (source, columns) in CONVERTED.items())


def circle(tables: dict[str, tuple[str, str, str]], rounds: int) -> str:
    """Rows of tables whose NOT NULL columns point at each other, by table: (wanted old id, its table, further column).

    Round by round, rows go whose reference leads to no row of a group that is left, until no more can.
    """
    steps = []
    for t in tables:
        wanted, _, _ = tables[t]
        key = KEYS[t]
        group = (
            f"case when {all_of('{} is null', key, ' or ')} then 'row ' || snapshot_id || ' ' || _id"
            f" else {all_of('cast({} as varchar)', key, joiner=' || chr(31) || ')} end"
        )
        steps.append(f"g_{t} as materialized (select *, {group} as g, {wanted} as wanted from {source_of(t, tables)})")
        steps.append(f"a_{t}_0 as materialized (select * from g_{t} where timestamp is not null)")
    for k in range(rounds):
        for t, (_, target, _) in tables.items():
            steps.append(
                f"a_{t}_{k + 1} as materialized (select a.* from a_{t}_{k} a join g_{target} t on t.snapshot_id = a.snapshot_id"
                f" and t._id = a.wanted where t.g in (select g from a_{target}_{k}))"
            )
    for t in tables:
        steps.append(
            f"kept_{t} as materialized (select *, row_number() over (order by timestamp, merge_rank, _id) as new_id from (select *,"
            f" row_number() over (partition by g order by merge_rank, timestamp, _id) as rn from a_{t}_{rounds}) as q where rn = 1)"
        )
    parts = [
        f"select '{t}' as table_name, k.new_id as _id, k.key_id, k.from_me, k.timestamp, r.new_id as {shown} from kept_{t} k"
        f" join g_{target} t on t.snapshot_id = k.snapshot_id and t._id = k.wanted join kept_{target} r on r.g = t.g"
        for t, (_, target, shown) in tables.items()
    ]
    return f"(with {', '.join(steps)} {' union all '.join(parts)}) as q"


def row_before(step: int) -> str:
    return f"case when ((_id - 1) // 3) % {step} = 0 then _id else _id - 3 end"


def source_of(table: str, circled) -> str:
    """Rows with references rewritten but for those into the circle, of which the old ids are kept."""
    references = {c: r for c, r in REFERENCES[table].items() if r[0] not in circled}
    joins = " ".join(
        f"left join m_{target} x{n} on x{n}.snapshot_id = d.snapshot_id and x{n}.old_id = d.{c}"
        for n, (c, (target, _)) in enumerate(references.items())
    )
    new = ", ".join(
        f"{f'coalesce(x{n}.new_id, 0)' if zero else f'x{n}.new_id'} as {c}" for n, (c, (_, zero)) in enumerate(references.items())
    )
    return f"(select d.* replace ({new}), k.merge_rank from d_{table} d join ranks k on k.snapshot_id = d.snapshot_id {joins}) as source"


def with_child(parent: str, column: str, survivors: str) -> str:
    """Rows of a main table of which only `survivors` stay, and the references to it of another table."""
    key, referable = KEYS[parent], all_of("{} is not null", MAP_KEYS[parent])
    own = all_of("{} is null", key, " or ")
    mapped = (
        f"select r.snapshot_id, r._id as old_id, s.new_id from r_{parent} r join ({survivors}) as s on"
        f" {all_of('r.{0} = s.{0}', key)} where {all_of('r.{} is not null', MAP_KEYS[parent])} union all"
        f" select snapshot_id, _id, new_id from ({survivors}) as s where ({own}) and {referable}"
    )
    child = (
        f"(select row_number() over (order by k.merge_rank, d._id) as _id, a.new_id as {column} from d_references_of_events d"
        f" join ranks k on k.snapshot_id = d.snapshot_id left join ({mapped}) as a"
        f" on a.snapshot_id = d.snapshot_id and a.old_id = d.{column}) as c"
    )
    rows = row_text(parent, f"({survivors}) as s", ("new_id", *COLUMNS[parent]))
    return f"{rows} union all {row_text('references_of_events', child, ('_id', column))}"


def oracle_sql() -> dict[str, str]:
    props = (
        "select 'props' as table_name, coalesce(key, '~') || '|' || coalesce(case when key = 'fts_ready' then '0' else value"
        " end, '~') as row_text from d_props where snapshot_id = 2 and (key is null or key <> 'fts_index_start')"
    )
    path = "'snapshot_' || cast({} as varchar)".format
    max_times = "select snapshot_id, max(timestamp) as max_ts from d_message group by snapshot_id"
    by_fifth = (
        "select cast(f.snapshot_id as int) as snapshot_id, 'archive_' || cast(f.snapshot_id as varchar) as path,"
        " max(case f.snapshot_id when 3 then null when 4 then -1 else epoch_us(o.o_orderdate) // 1000 end) as max_ts"
        " from (select distinct o_orderkey % 5 as snapshot_id from orders) f join orders o on o.o_orderkey % 5 ="
        " f.snapshot_id group by f.snapshot_id"
    )
    aligned = (
        "select cast(0 as int) as snapshot_id, cast(c_custkey as bigint) as old_id, c_name as raw_string,"
        " cast(null as int) as nation, 'none' as segment from customer where c_custkey % 6 <> 0 union all"
        " select 1, c_custkey, c_name, c_nationkey, 'none' from customer where c_custkey % 6 <> 1 union all"
        " select 2, c_custkey, c_name, case when c_custkey % 4 = 0 then null else c_nationkey end, c_mktsegment"
        " from customer where c_custkey % 6 <> 2"
    )
    given = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
    listing = " union all ".join(
        f"select '{t}' as table_name, (select string_agg(column_name, ',') from (describe {t})) as columns,"
        f" (select count(*) from {t}) as n_rows"
        for t in given
    )
    kept_rows = {t: ", ".join(["new_id as _id", "snapshot_id", "_id as old_id", *KEYS[t]]) for t in MAIN}
    sql = {
        "merge_messages_latest": "select c._id as chat_id, j.raw_string, a.last_id, a.latest, a.n as n_messages"
        " from t_chat c join activity a on a.chat_row_id = c._id join t_jid j on j._id = c.jid_row_id",
        "scan_snapshots_union": "select d.snapshot_id, cast(k.merge_rank as int) as merge_rank, d._id as old_id, d.key_id, d.timestamp, d.status"
        " from d_message d join ranks k on k.snapshot_id = d.snapshot_id",
        "align_common_columns": aligned,
        "source_validation": f"select *, case when max_ts >= 0 then 1 else 0 end as is_valid from ({by_fifth}) as q",
        "rank_snapshots": f"select cast(snapshot_id as int) as snapshot_id, {path('snapshot_id')} as path, max_ts,"
        f" cast(row_number() over (order by max_ts desc, snapshot_id) as int) as merge_rank,"
        f" cast(case when row_number() over (order by max_ts desc, snapshot_id) = 1 and max_ts > 0 then 1 else 0 end"
        f" as int) as is_base from ({max_times}) as q",
        "reid_messages": "select _id, sort_id, timestamp, key_id, from_me, status from t_message",
        "map_rank_zip": "select r.snapshot_id, r._id as old_id, t.new_id from z_rows r join z_targets t on"
        " r.key_id = t.key_id and r.from_me = t.from_me and r.rn = t.rn and t.merge_rank <= r.merge_rank",
        "remap_message_children": "select * from t_message_link",
        "remap_every_rule": "select * from t_references_of_events",
        "remap_sentinel": row_text("call_log", "t_call_log", ("_id", *COLUMNS["call_log"]))
        + " union all "
        + row_text("missed_call_logs", "t_missed_call_logs", ("_id", *COLUMNS["missed_call_logs"]))
        + " union all "
        + row_text("message_add_on", "t_message_add_on", ("_id", *COLUMNS["message_add_on"])),
        "remap_chat_exception": "select * from t_chat",
        "minor_bag_union": "select * from t_missed_call_logs",
        "reject_not_null": "select cast(snapshot_id as int) as snapshot_id, _id as old_id, message_row_id"
        " from r_message_link where message_row_id is null",
        "chat_pointers": "select _id, display_message_row_id, last_read_message_sort_id, ephemeral_message_row_id"
        " from chat_kept",
        "chat_pointers_cleared": "select _id, display_message_row_id, last_read_message_sort_id,"
        " ephemeral_message_row_id from chat_cleared",
        "chat_hidden": "select _id, hidden from chat_kept",
        "chat_reaction_reset": "select _id, last_message_reaction_row_id, last_seen_message_reaction_row_id from chat_kept",
        "chat_sort_timestamp": "select _id, hidden, sort_timestamp from chat_kept",
        "frequent_top1": "select * from t_frequent",
        "frequents_top1": "select * from t_frequents",
        "props_reset": "select key, case when key = 'fts_ready' then '0' else value end as value from d_props"
        " where snapshot_id = 2 and (key is null or key <> 'fts_index_start')",
        "convert_messages": "select * from c_messages",
        "convert_links": "select l._id, c.chat_id as chat_row_id, l.message_row_id, l.link_index"
        " from l_messages_links l join l_contact c on c.raw_string = l.key_remote_jid",
        "convert_quotes": "select * from c_quotes",
        "convert_vcards": "select _id, message_row_id, vcard from l_messages_vcards",
        "convert_vcard_jids": "select v._id, j._id as vcard_jid_row_id, v.vcard_row_id, v.message_row_id"
        " from l_messages_vcards_jids v join l_jid j on j.raw_string = v.vcard_jid",
        "convert_frequents": "select f._id, j._id as jid_row_id, f.type, f.message_count from l_frequents f"
        " join l_jid j on j.raw_string = f.jid",
        "convert_thumbnails": "select m._id as message_row_id, t.thumbnail from l_message_thumbnails t"
        " join l_messages m on m.key_id = t.key_id",
        "convert_quote_flag": "select _id, cast(case when _id in (select message_row_id from c_quotes) then 2 end as int)"
        " as lookup_tables from c_messages",
        "convert_common_copy": "select name, _id, cast(null as varchar) as added from l_settings",
        "schema_listing": listing,
        # Merging in two steps gives the same archive as merging at once.
        "incremental_merge": whole_archive((*MAIN, *MINOR)),
        "merge_archive_full": f"{whole_archive((*MAIN, *MINOR))} union all {props}",
        "merge_archives_published": whole_archive((*MAIN, *MINOR)),
        "scan_many_snapshots": "select cast(o_orderkey % 40 as int) as snapshot_id, cast(o_orderkey as bigint) as old_id,"
        " o_orderpriority as text_data, cast(case when o_orderkey % 40 < 20 then o_custkey % 3 end as int) as part"
        " from orders",
        "tables_emptied": "select 'backup_changes' as table_name, cast(0 as bigint) as n_rows union all"
        " select 'labels', count(*) from t_labels",
        "reject_not_null_main": "select row_number() over (order by timestamp, merge_rank, _id) as _id,"
        f" {', '.join(COLUMNS['message_add_on'])} from (select *, row_number() over (partition by {', '.join(MESSAGE_KEY)}"
        " order by merge_rank, timestamp, _id) as rn from r_message_add_on where timestamp is not null and"
        f" parent_message_row_id is not null) as q where rn = 1 or {all_of('{} is null', MESSAGE_KEY, ' or ')}",
        "convert_archive_full": converted_archive(),
        "minor_table_own_ids": "select d.note, d._id, c.new_id as chat_row_id, m.new_id as message_row_id, w.shuffled"
        " from d_order_notes d left join m_chat c on c.snapshot_id = d.snapshot_id and c.old_id = d.chat_row_id"
        " left join m_message m on m.snapshot_id = d.snapshot_id and m.old_id = d.message_row_id,"
        " (select cast(0 as int) as shuffled union all select 1) w",
        "minor_declared_key": "select row_number() over (order by merge_rank, _id) as _id, message_row_id, link_index from"
        " (select *, row_number() over (partition by message_row_id, link_index order by merge_rank, _id) as rn"
        " from r_message_link) as q where rn = 1 or message_row_id is null or link_index is null",
        "unique_on_mapped_column": with_child(
            "message_vcard", "message_vcard_row_id",
            "select *, row_number() over (order by merge_rank, _id) as new_id from (select *, row_number() over"
            " (partition by message_row_id order by merge_rank, _id) as rn from r_message_vcard) as q"
            " where rn = 1 or message_row_id is null",
        ),
        "reject_not_null_self": "select * exclude (table_name) from "
        + circle({"message": (row_before(6), "message", "quoted_message_row_id")}, 7),
        "reject_not_null_circle": "select * from "
        + circle(
            {
                "message": (row_before(4), "message_add_on", "reference"),
                "message_add_on": ("parent_message_row_id", "message", "reference"),
            },
            10,
        ),
        "reject_not_null_children": with_child(
            "message_add_on", "message_add_on_row_id",
            "select *, row_number() over (order by timestamp, merge_rank, _id) as new_id from (select *, row_number() over"
            f" (partition by {', '.join(MESSAGE_KEY)} order by merge_rank, timestamp, _id) as rn from r_message_add_on"
            " where timestamp is not null and parent_message_row_id is not null) as q"
            f" where rn = 1 or {all_of('{} is null', MESSAGE_KEY, ' or ')}",
        ),
        "excluded_tables": " union all ".join(
            f"select '{name}' as table_name, count(*) as n_rows from {source}"
            for name, source in (
                ("jid", "t_jid"), ("chat", "t_chat"), ("message", "t_message"), ("jid_view", "d_jid"), ("named_jids", "d_jid"),
            )
        ),
        "scan_sqlite_files": "select cast(o_orderkey % 8 as int) as snapshot_id, cast(o_orderkey as bigint) * 1000003 as _id,"
        " case when o_orderkey % 11 <> 0 then 'K' || cast(o_orderkey as varchar) end as key_id,"
        f" {duck_millis('o_orderdate')} as timestamp, cast(o_totalprice as double) as price, o_orderpriority as text_data,"
        " case when o_orderkey % 5 <> 0 then hex(o_orderpriority) end as picture,"
        " case when o_orderkey % 2 = 1 then 'integer' else 'text' end as kind_class, cast(o_custkey as varchar) as kind from orders",
    }
    short = {
        "message_add_on": "add_on",
        "message_vcard": "vcard",
        "group_participant_user": "group_participant",
    }
    for t in MAIN:
        name = short.get(t, t)
        sql[f"dedupe_{name}"] = f"select {kept_rows[t]} from s_{t}"
        sql[f"map_{name}"] = f"select * from m_{t}"
    for t in ("call_log", "message_add_on", "message_vcard", "reporting_info"):
        sql[f"map_rank_zip_{short.get(t, t)}"] = f"select * from ym_{t}"
    return {name: statement(text) for name, text in sql.items()}


__all__ = ["MAIN", "MINOR", "PATHS", "oracle_sql"]

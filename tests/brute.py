"""The merge done row by row in memory, as a measure for the Spark one."""

from __future__ import annotations

MESSAGE_KEY = ("chat_row_id", "from_me", "key_id", "sender_jid_row_id")
ORDER = ("jid", "chat", "message", "message_add_on", "call_log", "message_vcard", "group_participant_user", "reporting_info")
KEYS = {
    "jid": ("raw_string",),
    "chat": ("jid_row_id",),
    "message": MESSAGE_KEY,
    "message_add_on": MESSAGE_KEY,
    "call_log": ("call_id", "from_me", "jid_row_id"),
    "message_vcard": ("message_row_id", "vcard"),
    "group_participant_user": ("group_jid_row_id", "user_jid_row_id"),
    "reporting_info": ("reporting_tag", "stanza_id"),
}
REFERABLE = {
    "message": ("key_id", "from_me"),
    "message_add_on": ("key_id", "from_me"),
    "call_log": ("call_id",),
    "message_vcard": ("message_row_id",),
    "reporting_info": ("message_row_id",),
}
TIMED = ("message", "message_add_on", "call_log")


def target(table, column):
    if "jid_row_id" in column:
        return "jid", table in ("message", "call_log")
    if "chat_row_id" in column:
        return "chat", False
    if "message_row_id" in column and table != "chat":
        return "message", False
    return None, False


def remapped(table, row, maps):
    new = {}
    for column, value in row.items():
        to, zero = target(table, column)
        if to is None:
            new[column] = value
        else:
            found = maps[to].get(value) if value is not None else None
            new[column] = 0 if found is None and zero else found
    return new


def weak_source(table, row, tables):
    """Looser key of a source row, following references inside its own snapshot."""
    by_id = lambda t, i: next((r for r in tables.get(t, []) if r["_id"] == i), None)
    text = lambda i: (by_id("jid", i) or {}).get("raw_string")
    if table == "jid":
        return (row["raw_string"],)
    if table == "chat":
        return (text(row["jid_row_id"]),)
    if table in ("message", "message_add_on"):
        return row["key_id"], row["from_me"]
    if table == "call_log":
        return (row["call_id"],)
    if table == "message_vcard":
        return ((by_id("message", row["message_row_id"]) or {}).get("key_id"),)
    if table == "group_participant_user":
        return text(row["group_jid_row_id"]), text(row["user_jid_row_id"])
    return None


def weak_merged(table, row, out):
    """Looser key of a merged row, following references inside the merged tables."""
    if table == "reporting_info":
        return (row["message_row_id"],)
    renamed = {t: [{**r, "_id": r["new"]} for r in rs] for t, rs in out.items()}
    return weak_source(table, row, renamed)


def insert(table, tables, rank, maps, out):
    """Adds a snapshot's rows that repeat no key."""
    timed = table in TIMED
    entering = [r for r in tables.get(table, []) if not timed or r["timestamp"] is not None]
    for r in sorted(entering, key=lambda r: (r["timestamp"], r["_id"]) if timed else r["_id"]):
        new = remapped(table, r, maps)
        key = tuple(new[c] for c in KEYS[table])
        if None in key or not any(tuple(k[c] for c in KEYS[table]) == key for k in out[table]):
            out[table].append({**new, "rank": rank, "old": r["_id"], "new": len(out[table]) + 1})


def strict_targets(table, tables, rank, maps, out):
    for r in tables.get(table, []):
        new = remapped(table, r, maps)
        if any(new[c] is None for c in REFERABLE.get(table, KEYS[table])):
            continue
        key = tuple(new[c] for c in KEYS[table])
        for k in out[table]:
            same = None not in key and tuple(k[c] for c in KEYS[table]) == key
            if same or (None in key and (k["rank"], k["old"]) == (rank, r["_id"])):
                maps[table][r["_id"]] = k["new"]


def zipped_targets(table, tables, maps, out):
    pairs = []
    for r in tables.get(table, []):
        weak = weak_source(table, r, tables)
        if table == "reporting_info":
            weak = (maps["message"].get(r["message_row_id"]),)
        if None not in weak:
            pairs.extend((r["_id"], k["new"]) for k in out[table] if weak_merged(table, k, out) == weak)
    used = set()
    for old, new_id in sorted(pairs):
        if old not in maps[table] and new_id not in used:
            maps[table][old] = new_id
            used.add(new_id)


def merge(snapshots, mode):
    """Snapshots come newest first. Returns kept rows per table, and the kept row, as (rank, old id), that
    each (table, rank, old id) leads to.

    Zipped maps see what is merged so far; strict ones see the finished table.
    """
    out = {t: [] for t in ORDER}
    maps = [{t: {} for t in ORDER} for _ in snapshots]
    if mode == "strict":
        for table in ORDER:
            for rank, tables in enumerate(snapshots, 1):
                insert(table, tables, rank, maps[rank - 1], out)
            for rank, tables in enumerate(snapshots, 1):
                strict_targets(table, tables, rank, maps[rank - 1], out)
    else:
        for rank, tables in enumerate(snapshots, 1):
            for table in ORDER:
                insert(table, tables, rank, maps[rank - 1], out)
                zipped_targets(table, tables, maps[rank - 1], out)
    references = {}
    for rank, by_table in enumerate(maps, 1):
        for table, found in by_table.items():
            for old, new_id in found.items():
                kept = out[table][new_id - 1]
                references[table, rank, old] = (kept["rank"], kept["old"])
    return out, references

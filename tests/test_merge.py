import random
from pathlib import Path

import brute
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sediment.errors import InvalidSnapshot
from sediment.operators.lookup import BROADCAST_BYTES
from sediment.plans.merge import Merge, merge_archives
from sediment.sources.archive import Constraints, FrameArchive
from sediment.specs import TableSpec, default_specs
from sediment.staging import Staging

SCHEMAS = {
    "jid": "_id long, raw_string string",
    "chat": "_id long, jid_row_id long, hidden int, sort_timestamp long, last_message_row_id long,"
    " ephemeral_message_row_id long, last_message_reaction_row_id long",
    "message": "_id long, chat_row_id long, from_me int, key_id string, sender_jid_row_id long, timestamp long,"
    " message_type int, text_data string, sort_id long",
    "message_add_on": "_id long, chat_row_id long, from_me int, key_id string, sender_jid_row_id long, timestamp long",
    "call_log": "_id long, call_id string, from_me int, jid_row_id long, timestamp long",
    "message_vcard": "_id long, message_row_id long, vcard string",
    "group_participant_user": "_id long, group_jid_row_id long, user_jid_row_id long",
    "reporting_info": "_id long, message_row_id long, reporting_tag string, stanza_id string",
    "message_link": "_id long, message_row_id long, chat_row_id long, timestamp long",
    "frequent": "_id long, jid_row_id long, type int, message_count long",
    "props": "key string, value string",
    "backup_changes": "_id long, what string",
    "message_view_x": "_id long, message_row_id long",
}


def archive(spark, path, declared=None, **tables):
    frames = {}
    for name, data in tables.items():
        names = [f.split()[0] for f in SCHEMAS[name].split(",")]
        full = [tuple(r.get(c) for c in names) if isinstance(r, dict) else r for r in data]
        frames[name] = spark.createDataFrame(full, SCHEMAS[name])
    return FrameArchive(path, frames, declared or {})


def random_tables(seed, newest):
    rnd = random.Random(seed)
    pick = rnd.choice
    shuffled = lambda n: rnd.sample(range(1, 60), n)
    jids = [{"_id": i, "raw_string": pick([None, *"abcd"])} for i in shuffled(7)]
    ids = [j["_id"] for j in jids] + [None, 99]
    chats = [{"_id": i, "jid_row_id": pick(ids)} for i in shuffled(6)]
    chat_ids = [c["_id"] for c in chats] + [None, 99]

    def keyed(n):
        return [
            {
                "_id": i,
                "chat_row_id": pick(chat_ids),
                "from_me": pick([0, 1]),
                "key_id": pick([None, "k1", "k2", "k3"]),
                "sender_jid_row_id": pick(ids),
                "timestamp": pick([None, 1, 2, 3, 4]),
            }
            for i in shuffled(n)
        ]

    messages = keyed(14)
    messages[0]["timestamp"] = newest
    message_ids = [m["_id"] for m in messages] + [None, 99]
    return {
        "jid": jids,
        "chat": chats,
        "message": messages,
        "message_add_on": keyed(8),
        "call_log": [
            {"_id": i, "call_id": pick([None, "c1", "c2"]), "from_me": 0, "jid_row_id": pick(ids), "timestamp": pick([None, 1, 2])}
            for i in shuffled(6)
        ],
        "message_vcard": [{"_id": i, "message_row_id": pick(message_ids), "vcard": pick("xy")} for i in shuffled(10)],
        "group_participant_user": [
            {"_id": i, "group_jid_row_id": pick(ids), "user_jid_row_id": pick(ids)} for i in shuffled(8)
        ],
        "reporting_info": [
            {"_id": i, "message_row_id": pick(message_ids), "reporting_tag": pick([None, "t"]), "stanza_id": pick("pqr")}
            for i in shuffled(6)
        ],
    }


@pytest.mark.parametrize("mode, seed, broadcast_bytes", [("strict", 1, 0), ("rank_zip", 2, 32 << 20)])
def test_merge_equals_row_by_row_merge(spark, staging, mode, seed, broadcast_bytes, monkeypatch):
    if not broadcast_bytes:
        # Spark itself must not broadcast either, and hot keys are split.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        monkeypatch.setattr("sediment.operators.lookup.TASK_ROWS", 3)
    try:
        check_merge(spark, staging, mode, seed, broadcast_bytes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def check_merge(spark, staging, mode, seed, broadcast_bytes):
    snapshots = [random_tables(seed * 10 + i, 100 - i) for i in range(3)]
    specs = {**default_specs(), "call_log": TableSpec(**{**default_specs()["call_log"].__dict__, "natural_key": brute.KEYS["call_log"]})}
    archives = [archive(spark, f"s{i}", **t) for i, t in enumerate(snapshots)]
    merge = Merge(spark, archives, specs, staging, map_mode=mode, broadcast_bytes=broadcast_bytes)
    merge.build_keys()
    want, references = brute.merge(snapshots, mode)
    for table in brute.ORDER:
        kept = merge.survivors[table].rows.collect()
        assert sorted((r["merge_rank"], r["old_id"]) for r in kept) == sorted((r["rank"], r["old"]) for r in want[table]), table
        by_id = {r["new_id"]: (r["merge_rank"], r["old_id"]) for r in kept}
        assert sorted(by_id) == list(range(1, len(kept) + 1))
        order = (lambda r: (r["timestamp"], r["merge_rank"], r["old_id"])) if table in brute.TIMED else (lambda r: (r["merge_rank"], r["old_id"]))
        assert [r["new_id"] for r in sorted(kept, key=order)] == sorted(by_id)
        got = {(table, r["snapshot_id"] + 1, r["old_id"]): by_id[r["new_id"]] for r in merge.maps[table].df.collect()}
        assert got == {k: v for k, v in references.items() if k[0] == table}, table


def small(spark, path="a", newest=50, text="new", **more):
    tables = {
        "jid": [(1, "alice"), (2, "bob"), (3, "carol"), (4, "dora")],
        "chat": [(11, 1, 1, 7, 900, 901, 902), (12, 2, 1, 7, 900, 901, 902), (13, 3, 1, 7, 900, 901, 902)],
        "message": [
            (101, 11, 0, "m1", 1, 10, 0, text, 0),
            (102, 11, 1, "m2", None, newest, 1, None, 0),
            (103, 12, 0, "m3", 2, 30, 7, "system", 0),
            (104, 13, 0, "m4", 9, 20, 0, None, 0),
            (105, 11, 0, "m5", 1, None, 0, "no time", 0),
        ],
        "message_vcard": [(201, 101, "v"), (202, 101, "v"), (203, 999, "v")],
        "message_link": [(301, 101, 11, None), (302, 105, 11, 5), (303, 103, 12, 5)],
        "frequent": [(401, 1, 0, 5), (402, 1, 1, 9), (403, 77, 0, 1), (404, 78, 1, 3)],
        "props": [("fts_index_start", "9"), ("fts_ready", "5"), (None, "1"), ("other", "1")],
        "backup_changes": [(1, "x")],
        "message_view_x": [(1, 101)],
    }
    return archive(spark, path, **{**tables, **more})


def test_whole_merge(spark):
    older = small(spark, "older", 40, "old", props=[("mine", "1")])
    result = merge_archives(spark, [older, small(spark, "newer")], stale="keep")
    t = result.tables
    assert [r.path for r in result.ranked] == ["newer", "older"] and result.ranked[0].is_base
    # One row per contact; all old ids lead to it.
    assert rows(t["jid"]) == [(1, "alice"), (2, "bob"), (3, "carol"), (4, "dora")]
    assert rows(result.maps["jid"]) == sorted((s, i, i) for s in (0, 1) for i in (1, 2, 3, 4))
    # The newest snapshot's whole row; ids in time order; an unknown sender is 0; no time, no message.
    assert rows(t["message"], "_id", "key_id", "sender_jid_row_id", "timestamp", "text_data", "sort_id") == [
        (1, "m1", 1, 10, "new", 1),
        (2, "m4", 0, 20, None, 2),
        (3, "m3", 2, 30, "system", 3),
        (4, "m2", 0, 50, None, 4),
    ]
    # Chat 1 shows m2. Chat 2 has system messages only. Chat 3 has only a text without text.
    assert rows(t["chat"]) == [
        (1, 1, 0, 50, 4, 901, None),
        (2, 2, 1, 7, 900, 901, None),
        (3, 3, 0, 20, 900, 901, None),
    ]
    # Copies of a card become one; a card without a message stays, once per snapshot.
    assert rows(t["message_vcard"]) == [(1, 1, "v"), (2, None, "v"), (3, None, "v")]
    # Minor tables: bag union, rows without time stay, references to lost rows are null.
    assert rows(t["message_link"]) == [
        (1, 1, 1, None), (2, None, 1, 5), (3, 3, 2, 5), (4, 1, 1, None), (5, None, 1, 5), (6, 3, 2, 5),
    ]
    assert rows(t["frequent"], "jid_row_id", "type", "message_count") == [(None, 1, 3), (1, 1, 9)]
    assert rows(t["props"]) == [(None, "1"), ("fts_ready", "0"), ("other", "1")]
    assert t["backup_changes"].collect() == [] and t["backup_changes"].columns == ["_id", "what"]
    assert "message_view_x" not in t and any("message_view_x" in n for n in result.notes)
    result.discard()


def test_stale_pointers_can_be_cleared_and_views_included(spark):
    result = merge_archives(spark, [small(spark)], include_tables=["message_view_x"])
    assert rows(result.tables["chat"], "_id", "last_message_row_id") == [(1, 4), (2, None), (3, None)]
    assert rows(result.tables["message_view_x"]) == [(1, 1)]
    result.discard()


def test_children_of_copies(spark):
    """Two rows of one key in one snapshot, each with a card of its own."""
    copies = [(101, 11, 0, "m1", 1, 10, 0, "a", 0), (102, 11, 0, "m1", 1, 11, 0, "b", 0)]
    links = [(301, 101, 11, 1), (302, 102, 11, 2)]
    snapshot = small(spark, message=copies, message_link=links)
    strict = merge_archives(spark, [snapshot])
    assert rows(strict.tables["message_link"], "message_row_id") == [(1,), (1,)]
    weak = merge_archives(spark, [snapshot], map_mode="rank_zip")
    assert rows(weak.tables["message_link"], "timestamp", "message_row_id") == [(1, 1), (2, None)]


def test_merging_twice_the_same_changes_nothing_with_a_key(spark):
    once = merge_archives(spark, [small(spark)]).tables
    twice = merge_archives(spark, [small(spark), small(spark, "b")]).tables
    for table in ("jid", "chat", "message"):
        assert rows(once[table]) == rows(twice[table])
    assert twice["message_link"].count() == 2 * once["message_link"].count()


def test_declared_constraints(spark):
    declared = {
        "message_link": Constraints(not_null=("message_row_id",), unique=(("message_row_id",),)),
        "frequent": Constraints(unique=(("jid_row_id", "type"),)),
    }
    base = small(spark)
    base.declared = declared
    result = merge_archives(spark, [base, small(spark, "b", 40)])
    assert rows(result.tables["message_link"], "message_row_id") == [(1,), (3,)]
    assert rows(result.quarantine["message_link"]) == [(0, 302, None), (1, 302, None)]


def test_column_and_table_differences(spark, frame):
    base = small(spark)
    older = small(spark, "b", 40)
    older.frames = {
        **older.frames,
        "message_link": frame("_id long, message_row_id long, own int", (301, 101, 1)),
        "frequent": frame("other int", (1,)),
        "only_here": frame("_id long", (1,)),
        "jid": frame("_id int, raw_string string, extra int", (1, "alice", 5), (8, "eve", 6)),
    }
    specs = {**default_specs(), "message_link": TableSpec("message_link", defaults={"timestamp": 77})}
    result = merge_archives(spark, [base, older], specs=specs)
    assert (4, 1, None, 77) in rows(result.tables["message_link"])
    assert rows(result.tables["jid"]) == [(1, "alice"), (2, "bob"), (3, "carol"), (4, "dora"), (5, "eve")]
    notes = "\n".join(result.notes)
    assert "b: tables the base lacks: only_here" in notes
    assert "b: message_link columns the base lacks: own" in notes
    assert "b: frequent skipped, no common columns" in notes


def test_an_id_that_is_not_first_is_kept(spark, frame):
    base, older = small(spark), small(spark, "b", 40)
    for a, shift in ((base, 0), (older, 100)):
        a.frames = {
            **a.frames,
            "labels": frame("label_name string, _id long", ("x", shift + 7), (f"y{shift}", shift + 9)),
            "labeled": frame("label_id long, note string", (shift + 7, "a"), (shift + 9, "b")),
        }
    result = merge_archives(spark, [base, older])
    assert rows(result.tables["labels"]) == [("x", 7), ("y0", 9), ("y100", 109)]
    assert rows(result.tables["labeled"]) == [(7, "a"), (7, "a"), (9, "b"), (109, "b")]


def test_a_missing_main_table_resolves_nothing(spark):
    base, older = small(spark), small(spark, "b", 40)
    older.frames = {k: v for k, v in older.frames.items() if k != "chat"}
    result = merge_archives(spark, [base, older])
    keys = rows(result.tables["message"].where("chat_row_id is null"), "key_id")
    assert keys == [("m1",), ("m2",), ("m3",), ("m4",)]


def test_every_reference_exists(spark):
    snapshots = [random_tables(70 + i, 100 - i) for i in range(2)]
    result = merge_archives(spark, [archive(spark, f"s{i}", **t) for i, t in enumerate(snapshots)])
    t = result.tables
    for child, column, parent in (
        ("chat", "jid_row_id", "jid"), ("message", "chat_row_id", "chat"), ("message_vcard", "message_row_id", "message"),
        ("reporting_info", "message_row_id", "message"), ("group_participant_user", "user_jid_row_id", "jid"),
    ):
        used = t[child].where(F.col(column).isNotNull()).select(column)
        assert used.join(t[parent], F.col(column) == t[parent]["_id"], "left_anti").count() == 0


def test_stops_on_bad_input(spark, frame):
    with pytest.raises(InvalidSnapshot, match="empty"):
        merge_archives(spark, [small(spark), small(spark, "empty", message=[])])
    with pytest.raises(ValueError):
        merge_archives(spark, [])
    real = frame("_id long, timestamp double", (1, 5.0))
    with pytest.raises(InvalidSnapshot, match="whole numbers in: real"):
        merge_archives(spark, [FrameArchive("real", {"message": real})])
    with pytest.raises(ValueError, match="map_mode"):
        merge_archives(spark, [small(spark)], map_mode="other")


@pytest.mark.parametrize("limit", [BROADCAST_BYTES, 0])
def test_what_written_tables_were_made_from_goes(spark, staging, limit):
    archives = [archive(spark, f"s{i}", **random_tables(7 + i, 40)) for i in range(2)]
    read = Merge(spark, archives, default_specs(), Staging(spark), broadcast_bytes=limit)
    read.build_keys()
    want = {t: rows(df) for t, df in read.tables(lambda _, df: df).items()}
    merge = Merge(spark, archives, default_specs(), staging, broadcast_bytes=limit)
    merge.build_keys()
    done = merge.tables(staging.write)
    assert {t: rows(df) for t, df in done.items()} == want and sum(map(len, want.values())) > 50
    root = Path(staging.root.removeprefix("file:"))
    left = {p.name for p in root.iterdir()} - {*done, *(f"{t}_map" for t in merge.maps)}
    assert left <= {f"{t}_remapped" for t in merge.refused}, left

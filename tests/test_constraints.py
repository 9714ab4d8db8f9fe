"""Keys, NOT NULL columns, defaults and ids: what a store declares holds in what is written."""

import sqlite3
from dataclasses import replace
from pathlib import Path
from random import Random

import pytest
from conftest import rows
from pyspark.sql import types as T

from sediment import convert_archive, merge_archives
from sediment.operators.checks import repeated_ids
from sediment.errors import DuplicateKey, InvalidSnapshot, NullValue
from sediment.plans.merge import Merge
from sediment.sources.archive import Constraints, FrameArchive, ParquetArchive, SqliteArchive
from sediment.specs import TableSpec, default_specs

ADD_ON = "_id long, chat_row_id long, from_me int, key_id string, sender_jid_row_id long, timestamp long, parent_message_row_id long"
MESSAGE = "_id long, chat_row_id long, from_me int, key_id string, sender_jid_row_id long, timestamp long, message_type int, text_data string"


def snapshot(frame, path, time, add_ons, reactions=(), declared=None):
    """A chat with one message, add-ons and rows that point at them."""
    return FrameArchive(
        path,
        {
            "jid": frame("_id long, raw_string string", (1, "j")),
            "chat": frame("_id long, jid_row_id long", (1, 1)),
            "message": frame(MESSAGE, (1, 1, 0, "k", 1, time, 0, "t")),
            "message_add_on": frame(ADD_ON, *add_ons),
            "message_add_on_reaction": frame("message_add_on_row_id long, r string", *reactions),
        },
        declared or {},
    )


@pytest.mark.parametrize("mode", ["strict", "rank_zip"])
def test_a_refused_row_takes_no_key_and_no_id(spark, frame, mode):
    declared = {"message_add_on": Constraints(not_null=("parent_message_row_id",))}
    # The newest copy of a1 points nowhere, the older one at the message.
    new = snapshot(frame, "new", 20, [(1, 1, 0, "a1", 1, 5, 99), (2, 1, 0, "a2", 1, 6, 1)], [(1, "x"), (2, "y")], declared)
    old = snapshot(frame, "old", 10, [(7, 1, 0, "a1", 1, 5, 1)], [(7, "z")])
    result = merge_archives(spark, [new, old], map_mode=mode)
    kept = rows(result.tables["message_add_on"], "_id", "key_id", "parent_message_row_id")
    assert kept == [(1, "a1", 1), (2, "a2", 1)]
    ids = {r[0] for r in kept}
    assert {r[0] for r in rows(result.maps["message_add_on"], "new_id")} <= ids
    # A one-to-one map has no place for the refused copy, so a reference to it is cleared.
    assert {r[0] for r in rows(result.tables["message_add_on_reaction"], "message_add_on_row_id")} <= {None, *ids}
    assert rows(result.quarantine["message_add_on"], "snapshot_id", "old_id") == [(0, 1)]
    result.discard()


def test_a_unique_key_over_a_reference_is_enforced(spark, frame):
    declared = {"message_add_on": Constraints(unique=(("parent_message_row_id",),))}
    one = snapshot(frame, "one", 20, [(1, 1, 0, "a1", 1, 5, 1), (2, 1, 0, "a2", 1, 6, 1), (3, 1, 0, "a3", 1, 6, None)], (), declared)
    result = merge_archives(spark, [one])
    assert rows(result.tables["message_add_on"], "key_id") == [("a1",), ("a3",)]
    result.discard()


def test_keys_in_a_circle_stop_the_merge(spark, frame):
    specs = {**default_specs(), "message_add_on": TableSpec("message_add_on", "main", ("message_add_on_row_id",))}
    archive = snapshot(frame, "one", 20, [(1, 1, 0, "a1", 1, 5, 1)])
    archive.frames["message_add_on"] = frame("_id long, message_add_on_row_id long", (1, 1))
    with pytest.raises(InvalidSnapshot, match="message_add_on"):
        merge_archives(spark, [archive], specs=specs)


CIRCLE_MESSAGE = "_id long, chat_row_id long, from_me int, key_id string, sender_jid_row_id long, timestamp long, quoted_message_row_id long, first_message_add_on_row_id long, message_type int, text_data string"


def plain_circle(snapshots, not_null):
    """(table, key) to the (rank, id) of the row that stands for it, rows refused one after another until none is."""
    alive = {(t, rank, r[0]): r for rank, tables in enumerate(snapshots) for t, rows in tables.items() for r in rows}
    keys = {row: (row[0], r[3]) for row, r in alive.items()}
    places = {"message": {"quoted_message_row_id": ("message", 6), "first_message_add_on_row_id": ("message_add_on", 7)},
              "message_add_on": {"parent_message_row_id": ("message", 6)}}
    while True:
        mapped = {keys[row] for row in alive}
        bad = [
            row for row, r in alive.items()
            if any(keys.get((to, row[1], r[i])) not in mapped for to, i in (places[row[0]][c] for c in not_null[row[0]]))
        ]
        if not bad:
            break
        for row in bad:
            del alive[row]
    kept = {}
    for row in sorted(alive, key=lambda row: (row[1], alive[row][5], row[2])):
        kept.setdefault(keys[row], row[1:])
    return kept


@pytest.mark.parametrize("limit", [32 << 20, 0])
@pytest.mark.parametrize(
    "not_null",
    [
        {"message": ("quoted_message_row_id",), "message_add_on": ()},
        {"message": ("first_message_add_on_row_id",), "message_add_on": ("parent_message_row_id",)},
        {"message": ("quoted_message_row_id", "first_message_add_on_row_id"), "message_add_on": ("parent_message_row_id",)},
    ],
)
def test_not_null_columns_in_a_circle(spark, frame, not_null, limit):
    random = Random(7)
    snapshots, archives = [], []
    for rank in range(3):
        ids = list(range(1 + 1000 * rank, 61 + 1000 * rank))
        random.shuffle(ids)
        # Few keys are new to a snapshot, so most groups have several rows, and a chain of references runs through them.
        own = dict(enumerate(ids))
        near = lambda i: own.get(max(i - random.choice((0, 1, 1, 1)), 0)) if random.random() < 0.6 else 9999  # noqa: E731, B023
        messages = [(own[i], 1, 0, f"k{i}", 1, 500 - rank, near(i), near(i), 0, "t") for i in range(60) if random.random() < 0.95]
        add_ons = [(own[i], 1, 0, f"a{i}", 1, 400, near(i)) for i in range(60) if random.random() < 0.95]
        snapshots.append({"message": messages, "message_add_on": add_ons})
        archives.append(
            FrameArchive(
                f"s{rank}",
                {
                    "jid": frame("_id long, raw_string string", (1, "j")),
                    "chat": frame("_id long, jid_row_id long", (1, 1)),
                    "message": frame(CIRCLE_MESSAGE, *messages),
                    "message_add_on": frame(ADD_ON, *add_ons),
                },
                {t: Constraints(not_null=c) for t, c in not_null.items()},
            )
        )
    want = plain_circle(snapshots, not_null)
    result = merge_archives(spark, archives, broadcast_bytes=limit)
    for t in ("message", "message_add_on"):
        kept = {r["key_id"]: r for r in result.tables[t].collect()}
        assert set(kept) == {k for of, k in want if of == t} and kept
        assert not any(kept[k][c] is None for k in kept for c in not_null[t])
        # Each key's row is the newest snapshot's of those that stay, and every copy leads to it.
        maps = {(r["snapshot_id"], r["old_id"]): r["new_id"] for r in result.maps[t].collect()}
        assert all(maps[want[t, k]] == r["_id"] for k, r in kept.items())
        stay = {k for of, k in want if of == t}
        assert maps == {
            (rank, r[0]): kept[r[3]]["_id"] for rank, tables in enumerate(snapshots) for r in tables[t] if r[3] in stay
        }
        if t in result.quarantine:
            refused = result.quarantine[t].collect()
            assert len({(r["snapshot_id"], r["old_id"]) for r in refused}) == len(refused)
            assert not {(r["snapshot_id"], r["old_id"]) for r in refused} & {want[t, k] for k in stay}
            assert refused and all(any(r[c] is None for c in not_null[t]) for r in refused)
    assert len(want) < len({(t, r[3]) for tables in snapshots for t, rows in tables.items() for r in rows})
    result.discard()


def test_a_long_chain_of_refused_rows(spark, frame):
    """Rows that only hold each other up stay; a chain that ends nowhere goes whole."""
    chain = [(i, 1, 0, f"k{i}", 1, 5, i + 1, None, 0, "t") for i in range(1, 13)] + [(50, 1, 0, "x", 1, 5, 51, None, 0, "t"), (51, 1, 0, "y", 1, 5, 50, None, 0, "t")]
    archive = FrameArchive(
        "one",
        {
            "jid": frame("_id long, raw_string string", (1, "j")),
            "chat": frame("_id long, jid_row_id long", (1, 1)),
            "message": frame(CIRCLE_MESSAGE, *chain),
        },
        {"message": Constraints(not_null=("quoted_message_row_id",))},
    )
    result = merge_archives(spark, [archive])
    assert rows(result.tables["message"], "key_id", "_id", "quoted_message_row_id") == [("x", 1, 2), ("y", 2, 1)]
    assert rows(result.quarantine["message"], "old_id") == [(i,) for i in range(1, 13)]
    result.discard()
    with pytest.raises(InvalidSnapshot, match="message"):
        merge_archives(spark, [archive], map_mode="rank_zip")
    two_keys = {**default_specs(), "message": replace(default_specs()["message"], unique=(("key_id",),))}
    with pytest.raises(InvalidSnapshot, match="several keys in message"):
        merge_archives(spark, [archive], specs=two_keys)


def test_a_written_archive_keeps_its_keys(spark, tmp_path):
    paths = []
    for name, time in (("a", 100), ("b", 200)):
        paths.append(str(tmp_path / f"{name}.db"))
        with sqlite3.connect(paths[-1]) as c:
            c.executescript(
                """create table jid (_id integer primary key, raw_string text);
                create table chat (_id integer primary key, jid_row_id integer);
                create table message (_id integer primary key, chat_row_id integer, from_me integer, key_id text,
                  sender_jid_row_id integer, timestamp integer, message_type integer, text_data text);
                create table message_media (message_row_id integer primary key, size integer not null default 3, raw);
                insert into jid values (1, 'j'); insert into chat values (1, 1);"""
            )
            for i in range(1, 4 if name == "a" else 3):
                c.execute("insert into message values (?, 1, 0, ?, 1, ?, 0, 't')", (i, f"k{i}", time + i))
                c.execute("insert into message_media values (?, ?, ?)", (i, i, bytes([255, i])))
    out = str(tmp_path / "out")
    first = merge_archives(spark, paths, out)
    assert first.tables["message_media"].count() == 3
    known = ParquetArchive(spark, out).constraints("message_media")
    assert known.unique == (("message_row_id",),) and known.not_null == ("message_row_id", "size")
    assert known.defaults == {"size": 3} and ParquetArchive(spark, out).constraints("message").sure_ids
    # The same snapshot again adds nothing, whether the result or the file is the base.
    for sources in ([out, paths[0]], [paths[0], out]):
        again = merge_archives(spark, sources, str(tmp_path / f"again{len(sources[0])}"))
        assert {t: df.count() for t, df in again.tables.items()} == {t: df.count() for t, df in first.tables.items()}
    assert sorted(bytes(r.raw) for r in first.tables["message_media"].collect()) == [bytes([255, i]) for i in (1, 2, 3)]


def test_texts_that_are_not_utf8_stay_apart(spark, tmp_path):
    path = str(tmp_path / "a.db")
    with sqlite3.connect(path) as c:
        c.executescript(
            """create table jid (_id integer primary key, raw_string text);
            create table chat (_id integer primary key, jid_row_id integer);
            create table message (_id integer primary key, chat_row_id integer, from_me integer, key_id text,
              sender_jid_row_id integer, timestamp integer, message_type integer, text_data text);"""
        )
        for i, raw in enumerate((b"a\xff", b"a\xfe"), 1):
            c.execute("insert into jid values (?, cast(? as text))", (i, raw))
            c.execute("insert into chat values (?, ?)", (i, i))
            c.execute("insert into message values (?, ?, 0, 'k', ?, 5, 0, 't')", (i, i, i))
    result = merge_archives(spark, [path])
    assert {t: df.count() for t, df in result.tables.items()} == {"jid": 2, "chat": 2, "message": 2}
    assert any("jid.raw_string: 2 values" in n for n in result.notes)
    result.discard()


def test_untyped_columns_keep_their_bytes(spark, tmp_path):
    path = str(tmp_path / "a.db")
    with sqlite3.connect(path) as c:
        c.execute("create table t (x, y text)")
        c.executemany("insert into t values (?, ?)", [(b"\xff\x00", "a"), ("é", "b")])
    df = SqliteArchive(spark, path).read("t")
    assert df.schema["x"].dataType == T.BinaryType()
    assert sorted((bytes(r.x), r.y) for r in df.collect()) == [("é".encode(), "b"), (b"\xff\x00", "a")]


@pytest.mark.parametrize("bad", [[(None, "x"), (1, "y")], [(1, "x"), (1, "y")]])
def test_missing_or_repeated_ids_are_named(spark, frame, bad):
    archive = snapshot(frame, "odd", 20, [(1, 1, 0, "a1", 1, 5, 1)])
    archive.frames["notes_of_mine"] = frame("_id long, v string", *bad)
    with pytest.raises(InvalidSnapshot, match="notes_of_mine.*odd"):
        merge_archives(spark, [archive])


def legacy(frame):
    message = (
        "_id long, key_remote_jid string, key_from_me int, key_id string, remote_resource string, data string, status int, "
        "recipient_count int, participant_hash string, origin int, timestamp long, received_timestamp long, "
        "media_wa_type int, receipt_server_timestamp long, starred int, quoted_row_id long"
    )
    return FrameArchive(
        "legacy",
        {
            "jid": frame("_id long, raw_string string", (1, "j")),
            "chat": frame("_id long, jid_row_id long", (1, 1)),
            "messages": frame(message, (1, "j", 0, "k", None, "d", 1, 0, None, 0, 5, 6, 0, 7, 0, None)),
            "messages_vcards": frame("_id long, message_row_id long, vcard string", (1, 1, "v")),
            "settings": frame("_id long, name string", (1, "a"), (2, "b")),
        },
    )


def goal(frame, **declared):
    tables = {
        "jid": frame("_id long, raw_string string"),
        "settings": frame("_id long, name string, added string, level int"),
        "message": frame("_id long, key_id string, kind string"),
    }
    return FrameArchive("goal", tables, declared)


def test_conversion_fills_in_defaults(spark, frame):
    declared = {"settings": Constraints(defaults={"added": "new", "level": 4}), "message": Constraints(defaults={"kind": "m"})}
    result = convert_archive(spark, legacy(frame), target=goal(frame, **declared))
    assert rows(result.tables["settings"]) == [(1, "a", "new", 4), (2, "b", "new", 4)]
    assert rows(result.tables["message"]) == [(1, "k", "m")]
    result.discard()


def test_conversion_stops_at_nulls_and_repeated_keys(spark, frame, tmp_path):
    for declared, error in (
        (Constraints(not_null=("added",)), NullValue),
        (Constraints(unique=(("added",),), defaults={"added": "same"}), DuplicateKey),
    ):
        with pytest.raises(error, match="settings"):
            convert_archive(spark, legacy(frame), str(tmp_path / "out"), goal(frame, settings=declared))
    assert list(tmp_path.iterdir()) == []


def test_conversion_without_a_target_copies_no_table_it_makes(spark, frame):
    result = convert_archive(spark, legacy(frame))
    assert "message_vcard" in result.tables and "messages_vcards" not in result.tables
    result.discard()


OWN_IDS = [
    ("n1", 7, 2, 1), ("n2", 7, 2, 2), ("n3", None, 2, 1), ("n4", None, None, None), ("n5", 9, 2, 99), ("n5", 9, 2, 99),
]


@pytest.mark.parametrize("spark_broadcast", [True, False])
def test_a_table_with_ids_of_its_own_goes_by_the_places_of_its_rows(spark, frame, spark_broadcast):
    """Ids that are no surrogate repeat and are missing; broadcasting or not changes no row."""
    extra = "note string, _id long, chat_row_id long, message_row_id long"

    def archive(path, time, rows, schema=extra):
        return FrameArchive(path, {
            "jid": frame("_id long, raw_string string", (1, "a")), "chat": frame("_id long, jid_row_id long", (2, 1)),
            "message": frame(MESSAGE, (1, 2, 0, f"x{time}", 1, time, 0, "t"), (2, 2, 0, "y", 1, time + 1, 0, "t")), "extra": frame(schema, *rows),
        })

    snapshots = [archive("new", 10, OWN_IDS), archive("old", 1, [(n, c, m) for n, _, c, m in OWN_IDS], "note string, chat_row_id long, message_row_id long")]
    found = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m" if spark_broadcast else "-1")
    try:
        for limit in (32 << 20, 0):
            result = merge_archives(spark, snapshots, broadcast_bytes=limit)
            found[limit] = rows(result.tables["extra"])
            ids = {r["key_id"]: r["_id"] for r in result.tables["message"].collect()}
            chat = result.tables["chat"].first()["_id"]
            keyed = {"extra": TableSpec("extra", unique=(("note", "message_row_id"), ("_id", "note")))}
            kept = merge_archives(spark, snapshots, specs={**default_specs(), **keyed}, broadcast_bytes=limit)
            found[limit, "keyed"] = rows(kept.tables["extra"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    messages = {"new": {1: ids["x10"], 2: ids["y"]}, "old": {1: ids["x1"], 2: ids["y"]}}
    want = [
        (n, i if path == "new" else None, chat if c else None, messages[path].get(m)) for path in ("new", "old") for n, i, c, m in OWN_IDS
    ]
    known = lambda found: sorted(found, key=lambda r: tuple((v is not None, v) for v in r))
    assert found[32 << 20] == found[0] == known(want)
    # The repeated row of `n5` goes by its key; of `n2` the older copy does; rows with a null in both keys stay.
    assert found[32 << 20, "keyed"] == found[0, "keyed"]
    assert len(found[0, "keyed"]) == len(want) - 2


def test_repeated_ids_without_counting_each(spark, frame):
    ids = [(0, i) for i in range(-200, 200)] + [(1, i * 10**15) for i in range(50)] + [(2, 5), (2, 70), (2, 5), (3, None), (3, 1)]
    df = frame("snapshot_id int, old_id long", *ids)
    assert rows(repeated_ids(df, "snapshot_id", "old_id")) == [(2, 5, 2), (3, None, 1)]
    assert rows(repeated_ids(df.where("snapshot_id < 2"), "snapshot_id", "old_id")) == []


def test_tables_built_twice_read_and_map_their_keys_once(spark, frame, staging, monkeypatch):
    searched = []
    monkeypatch.setattr("sediment.operators.support.hot_keys", lambda df, keys: searched.append(keys) or {})
    n = 12
    # Each quotes the one before it; the first one's reference leads nowhere, so all fall one by one.
    message = frame(
        "_id long, chat_row_id long, from_me int, key_id string, sender_jid_row_id long, timestamp long, quoted_message_row_id long",
        *((i, 1, 0, f"k{i}", 1, 100 + i, i - 1 if i else 99) for i in range(n)),
        (50, 1, 0, "own", 1, 500, 50),
    )
    tables = {"jid": frame("_id long, raw_string string", (1, "a")), "chat": frame("_id long, jid_row_id long", (1, 1)), "message": message}
    specs = default_specs()
    specs["message"] = replace(specs["message"], not_null=("quoted_message_row_id",))
    merge = Merge(spark, [FrameArchive("a", tables)], specs, staging, broadcast_bytes=0)
    merge.build_keys()
    assert rows(merge.main_table("message"), "key_id") == [("own",)]
    root = Path(staging.root.removeprefix("file:"))
    assert len(list(root.rglob("message_rows"))) == 1
    assert len(searched) == 1 and not list(root.rglob("message_members"))

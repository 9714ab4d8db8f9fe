import pytest
from conftest import rows
from pyspark.sql import types as T

from sediment.errors import DuplicateKey
from sediment.operators import legacy
from sediment.operators.legacy import Contacts
from sediment.plans.convert import convert_archive
from sediment.sources.archive import FrameArchive

MESSAGES = (
    "_id long, key_remote_jid string, key_from_me int, key_id string, remote_resource string, data string, status int,"
    " recipient_count int, participant_hash string, origin int, timestamp long, received_timestamp long,"
    " media_wa_type int, receipt_server_timestamp long, starred int, quoted_row_id long"
)
QUOTES = (
    "_id long, key_remote_jid string, key_from_me int, key_id string, remote_resource string, timestamp long,"
    " media_wa_type int, origin int, data string, payment_transaction_id string"
)


def message(i, contact, key, resource=None, quoted=None):
    return (i, contact, 0, key, resource, f"text {i}", 1, 2, "h", 3, 100 + i, 200 + i, 0, 300 + i, 0, quoted)


def old_archive(frame, **changed):
    tables = {
        "jid": frame("_id long, raw_string string", (1, "a"), (2, "b"), (3, "c"), (4, None)),
        "chat": frame("_id long, jid_row_id long", (10, 1), (20, 2), (40, 4)),
        "messages": frame(
            MESSAGES,
            message(1, "a", "k1", "c"),
            message(2, "a", "k2", "unknown", 7),
            message(3, "c", "k3"),
            message(4, "nobody", "k4"),
            message(5, "b", "k1", None, 0),
            message(6, None, "k6", None, 8),
            message(9, "b", "k9", None, 7),
        ),
        "messages_quotes": frame(
            QUOTES, (7, "b", 1, "q7", "a", 50, 1, 2, "quoted", "pay"), (8, "c", 1, "q8", "a", 50, 1, 2, "no chat", None)
        ),
        "messages_links": frame(
            "_id long, key_remote_jid string, message_row_id long, link_index int", (1, "a", 1, 0), (2, "c", 3, 0)
        ),
        "messages_vcards": frame("_id long, message_row_id long, vcard string", (1, 1, "v"), (2, 77, "w")),
        "messages_vcards_jids": frame(
            "_id long, vcard_jid string, vcard_row_id long, message_row_id long", (1, "c", 1, 1), (2, "zz", 2, 77)
        ),
        "frequents": frame("_id long, jid string, type int, message_count long", (1, "a", 0, 5), (2, "zz", 0, 6)),
        "message_thumbnails": frame("key_id string, thumbnail binary", ("k1", bytearray(b"p")), ("zz", bytearray(b"q")), ("zz", bytearray(b"r"))),
        "settings": frame("_id long, name string, old_only int", (9, "s", 1)),
        "odd": frame("gone int", (1,)),
        "settings_view": frame("_id long", (1,)),
        **changed,
    }
    return FrameArchive("old", tables)


@pytest.mark.parametrize("limit", [None, 0])
def test_all_tables(spark, frame, limit):
    result = convert_archive(spark, old_archive(frame), broadcast_bytes=limit)
    t = result.tables
    # Contacts without a chat go, an unknown sender is 0.
    assert rows(t["message"], "_id", "chat_row_id", "sender_jid_row_id", "text_data", "message_type", "sort_id") == [
        (1, 10, 3, "text 1", 0, 1),
        (2, 10, 0, "text 2", 0, 2),
        (5, 20, 0, "text 5", 0, 5),
        (9, 20, 0, "text 9", 0, 9),
    ]
    assert rows(t["message"], "_id", "lookup_tables") == [(1, None), (2, 2), (5, None), (9, 2)]
    quoted = (20, 20, 1, 1, "q7", 50, 1, 2, "quoted", "pay", 0)
    assert rows(t["message_quoted"]) == [(2, *quoted), (9, *quoted)]
    assert rows(t["message_link"]) == [(1, 10, 1, 0)]
    assert rows(t["message_vcard"]) == [(1, 1, "v"), (2, 77, "w")]
    assert rows(t["message_vcard_jid"]) == [(1, 3, 1, 1)]
    assert rows(t["frequent"]) == [(1, 1, 0, 5)]
    assert rows(t["message_thumbnail"], "message_row_id") == [(1,), (5,)]
    assert rows(t["settings"]) == [(9, "s", 1)]
    assert "settings_view" not in t and "messages" not in t


def test_into_a_target_schema(spark, frame, tmp_path):
    target = {
        "jid": T.StructType.fromDDL("_id bigint, raw_string string, user string"),
        "message": T.StructType.fromDDL("_id bigint, text_data string, lookup_tables int, added string"),
        "message_quoted": T.StructType.fromDDL("message_row_id bigint, chat_row_id bigint"),
        "settings": T.StructType.fromDDL("name string, _id bigint"),
        "odd": T.StructType.fromDDL("other int"),
        "props": T.StructType.fromDDL("key string"),
        "backup_changes": T.StructType.fromDDL("_id bigint"),
    }
    result = convert_archive(spark, old_archive(frame), str(tmp_path / "out"), target)
    assert sorted(result.tables) == ["backup_changes", "jid", "message", "message_quoted", "settings"]
    assert rows(result.tables["jid"]) == [(1, "a", None), (2, "b", None), (3, "c", None), (4, None, None)]
    assert rows(result.tables["message"])[1] == (2, "text 2", 2, None)
    assert rows(result.tables["settings"]) == [("s", 9)]
    assert result.tables["backup_changes"].count() == 0
    assert "odd not copied, no common columns" in result.notes
    assert "message_link not made, the target lacks it" in result.notes
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == sorted([*result.tables, "_constraints"])


def test_a_missing_legacy_table_is_noted(spark, frame):
    archive = old_archive(frame)
    archive.frames = {t: df for t, df in archive.frames.items() if t != "messages_quotes"}
    result = convert_archive(spark, archive)
    assert "message_quoted not made, no messages_quotes" in result.notes
    assert rows(result.tables["message"], "lookup_tables") == [(None,)] * 4


def test_two_thumbnails_of_one_message(spark, frame):
    twice = frame("key_id string, thumbnail binary", ("k1", bytearray(b"p")), ("k1", bytearray(b"q")))
    with pytest.raises(DuplicateKey, match="key_id='k1'"):
        convert_archive(spark, old_archive(frame, message_thumbnails=twice))


def test_a_contact_with_two_chats_repeats_its_messages(spark, frame, tmp_path):
    two = frame("_id long, jid_row_id long", (10, 1), (11, 1))
    with pytest.raises(DuplicateKey, match="message_quoted|message: repeated key: _id=1"):
        convert_archive(spark, old_archive(frame, chat=two), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_pictures_fan_out_over_messages_of_a_key(frame):
    archive = old_archive(frame)
    got = legacy.thumbnails(archive.read("message_thumbnails"), archive.read("messages"), 0)
    assert rows(got, "message_row_id") == [(1,), (5,)]


def test_contacts(frame):
    archive = old_archive(frame)
    contacts = Contacts.of(archive.read("jid"), archive.read("chat"))
    assert contacts.fit()
    assert rows(contacts.chats.df) == [(None, 40), ("a", 10), ("b", 20)]

import pytest

from sediment.functions.names import (
    common,
    listing,
    match_rule,
    mergeable,
    plain_copies,
    pointer_columns,
    split_main_minor,
)
from sediment.operators.remap import foreign_keys


@pytest.mark.parametrize(
    "column, target",
    [
        ("jid_row_id", "jid"),
        ("vcard_jid_row_id", "jid"),
        ("business_owner_jid", "jid"),
        ("seller_jid", "jid"),
        ("participant_lid_row_id", "jid"),
        ("parent_message_chat_row_id", "chat"),
        ("message_row_id", "message"),
        ("parent_message_row_id_2", "message"),
        ("message_table_id", "message"),
        ("call_log_row_id", "call_log"),
        ("call_logs_row_id", "call_log"),
        ("message_add_on_row_id", "message_add_on"),
        ("message_vcard_row_id", "message_vcard"),
        ("quick_reply_id", "quick_replies"),
        ("reporting_info_row_id", "reporting_info"),
        ("label_id", "labels"),
        ("group_participant_row_id", "group_participant_user"),
        ("group_participant_user_row_id", "group_participant_user"),
        ("call_link_row_id", None),
        ("my_group_participant_row_id", None),
        ("group_participant_row_id_2", None),
        ("JID_ROW_ID", None),
        ("other_seller_jid", None),
    ],
)
def test_rule_of_a_column(column, target):
    rule = match_rule(column)
    assert (rule.target if rule else None) == target


def test_chat_copies_message_pointers():
    columns = ["_id", "jid_row_id", "last_message_row_id", "subject"]
    assert list(foreign_keys("chat", columns)) == ["jid_row_id"]
    assert list(foreign_keys("other", columns)) == ["jid_row_id", "last_message_row_id"]


def test_mergeable_names():
    names = ["jid", "message_view_x", "MESSAGE_FTS_x", "props", "sqlite_sequence", "Review", "message"]
    assert mergeable(names) == ["jid", "message"]
    assert mergeable(names, include=["message_view_x"]) == ["jid", "message_view_x", "message"]


def test_main_tables_come_in_key_order():
    main, minor = split_main_minor(["labels", "frequent", "message", "chat", "jid", "message_link"])
    assert main == ["jid", "chat", "message", "labels"]
    assert minor == ["frequent", "message_link"]


def test_plain_copies_of_a_migration():
    legacy = ["jid", "messages", "props", "settings_FTS", "frequents", "only_old"]
    target = ["props", "jid", "message", "frequents", "settings_FTS", "only_new"]
    assert plain_copies(legacy, target) == ["props", "jid"]


def test_pointer_columns():
    names = [
        "last_message_row_id",
        "Display_Message_Sort_Id",
        "messageXrowYid",
        "last_read_ephemeral_message_row_id",
        "last_message_reaction_row_id",
        "message_id",
    ]
    assert pointer_columns(names) == ["last_message_row_id", "Display_Message_Sort_Id", "messageXrowYid"]


def test_common_is_case_sensitive_and_keeps_order():
    assert common(["b", "A", "c"], ["a", "c", "b"]) == ["b", "c"]
    assert listing(["b", "c"]) == "b,c"

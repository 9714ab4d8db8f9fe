"""Registered queries against their SQL on the smallest given tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from compare import normalized
from sediment_checks import queries as registered
from sediment_checks.derived import Given, snapshot_frames

FOLDER = "/root/testdata/sf0.001"
# The rest of the registered queries is compared by compare.py; these cover all operators between them.
CHECKED = (
    "merge_messages_latest", "align_common_columns", "source_validation", "rank_snapshots", "map_rank_zip",
    "remap_chat_exception", "reject_not_null", "props_reset", "convert_messages", "convert_quotes", "convert_links",
    "convert_vcards", "convert_vcard_jids", "convert_frequents", "convert_thumbnails", "convert_quote_flag",
    "convert_common_copy", "schema_listing", "incremental_merge", "merge_archive_full", "map_reporting_info",
)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {f.stem} as select * from '{f}'")
    return connection


def test_every_query_has_sql():
    assert set(registered.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    got = normalized(entry.queries()[name](spark, FOLDER).toPandas())
    want = normalized(duck.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    assert got.equals(want)


def test_lines_are_numbered_once_for_all_snapshots(spark):
    given = Given(spark, FOLDER)
    for of in snapshot_frames(given, ["message_vcard", "message_link"]):
        for df in of.values():
            assert "Window" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert given["numbered_lines"].count() == given["lineitem"].count()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["chat_id", "raw_string", "last_id", "latest", "n_messages"]
    assert df.count() > 0

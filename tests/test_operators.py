import random
import re
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sediment.errors import DuplicateKey, InvalidSnapshot
from sediment.operators.align import align, cast_losses, common_columns, lossy_columns
from sediment.operators.checks import assert_unique, duplicates, split_nulls
from sediment.operators.dedupe import deciding, distinct_on_all, first_per_key, keyed_distinct
from sediment.operators.ids import assign_ordered_ids, number_within
from sediment.operators.lookup import BROADCAST_BYTES, Sized, hot_keys, lookup
from sediment.operators.rank import rank_snapshots
from sediment.operators.remap import ROW, remap

UNION = "snapshot_id int, merge_rank int, old_id long"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- lookup ---------------------------------------------------------------------------------------


def skewed(spark, n=20_000):
    """A third of the rows has key 7, a tenth has none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500)
    return spark.range(n).select("id", key.cast("long").alias("fk"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_by_shuffle_equals_lookup_by_broadcast(spark, how, monkeypatch):
    monkeypatch.setattr("sediment.operators.lookup.TASK_ROWS", 100)
    left = skewed(spark)
    right = Sized.of(spark.range(0, 400).select(F.col("id").alias("old_id"), (F.col("id") * 10).alias("new_id")))
    small = lookup(left, right, {"fk": "old_id"}, {"new_id": "new"}, how, ("id",))
    large = lookup(left, right, {"fk": "old_id"}, {"new_id": "new"}, how, ("id",), limit=0)
    assert large.columns == small.columns == ["id", "fk", "new"]
    assert rows(large) == rows(small)
    assert "_salt" in plan(large) and "_salt" not in plan(small)


def test_lookup_keeps_several_matches(spark, frame):
    left = frame("id long, k string", (1, "a"), (2, "a"), (3, None), (4, "c"))
    right = Sized.of(frame("k string, v int", ("a", 1), ("a", 2), ("b", 3), (None, 4)))
    want = [(1, "a", 1), (1, "a", 2), (2, "a", 1), (2, "a", 2)]
    for limit in (None, 0):
        assert rows(lookup(left, right, {"k": "k"}, {"v": "v"}, "inner", ("id",), limit)) == want
        full = rows(lookup(left, right, {"k": "k"}, {"v": "v"}, "left", ("id",), limit))
        assert full == [*want, (3, None, None), (4, "c", None)]


def test_hot_keys_are_those_with_more_rows_than_a_task_should_have(spark):
    left = skewed(spark)
    n = left.where("fk = 7").count()
    seven = left.where("fk = 7").select(F.xxhash64("fk")).first()[0]
    assert hot_keys(left, ["fk"], n // 10)[seven] in (10, 11)
    assert hot_keys(left, ["fk"], n * 2) == {}
    assert hot_keys(left.where("fk is null"), ["fk"], 1) == {}


def test_any_number_of_equally_hot_keys_is_split(spark):
    left = spark.range(0, 30_000).select("id", (F.col("id") % 300).alias("fk"))
    assert sorted(hot_keys(left, ["fk"], 25).values()) == [4] * 300


def test_keys_are_only_tracked_where_a_slot_is_crowded(spark, monkeypatch):
    left = spark.range(0, 30_000).select("id", F.when(F.col("id") % 50 == 0, -1).otherwise(F.col("id")).alias("fk"))
    hot = left.where("fk = -1").select(F.xxhash64("fk")).first()[0]
    assert hot_keys(left, ["fk"], 100) == {hot: 6}
    # The sketches got the hashes of crowded slots alone: so few are told exactly by the smallest ones.
    monkeypatch.setattr("sediment.operators.lookup.TRACKED_KEYS", 2)
    assert hot_keys(left, ["fk"], 100) == {hot: 6}
    # No sketch at all, which could not be made.
    monkeypatch.setattr("sediment.operators.lookup.TRACKED_KEYS", 0)
    assert hot_keys(left, ["fk"], 700) == {}


def test_shuffled_maps_are_sorted_by_ids_before_snapshots(spark, monkeypatch):
    monkeypatch.setattr("sediment.operators.lookup.hot_keys", lambda df, keys: {})
    maps = {t: Sized.of(spark.range(9).selectExpr("1 as snapshot_id", "id as old_id", "id + 1 as new_id")) for t in ("chat", "message")}
    df = spark.range(9).selectExpr("1 as snapshot_id", "id as old_id", "id as chat_row_id", "id as message_row_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for columns in (["chat_row_id"], ["chat_row_id", "message_row_id"]):
            done = remap(df.select("snapshot_id", "old_id", *columns), "t", maps, limit=0, row=ROW)
            assert rows(done, *columns) == [tuple([i + 1] * len(columns)) for i in range(9)]
            sorts = re.findall(r"Sort \[(\w+)#", plan(done))
            # A snapshot's number is the same in so many rows that it says nothing ahead of the id.
            assert sorts and "snapshot_id" not in sorts, sorts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_slot_may_be_crowded(spark, monkeypatch):
    monkeypatch.setattr("sediment.operators.lookup.SLOTS", 64)
    left = spark.range(0, 30_000).select("id", (F.col("id") % 300).alias("fk"))
    assert sorted(hot_keys(left, ["fk"], 25).values()) == [4] * 300


def test_without_hot_keys_nothing_is_copied(spark):
    left = spark.range(0, 3_000).select("id", (F.col("id") % 300).alias("fk"))
    right = Sized.of(spark.range(0, 300).select(F.col("id").alias("old_id"), F.col("id").alias("new_id")))
    joined = lookup(left, right, {"fk": "old_id"}, {"new_id": "new"}, "left", ("id",), limit=0)
    assert joined.where("fk = new").count() == 3_000
    assert "Generate" not in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_spread_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr("sediment.operators.lookup.TASK_ROWS", 100)
    left = skewed(spark)
    right = Sized.of(spark.range(0, 400).select(F.col("id").alias("old_id"), F.col("id").alias("new_id")))
    joined = lookup(left, right, {"fk": "old_id"}, {"new_id": "new"}, "left", ("id",), limit=0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(r["count"] for r in sizes) < 20_000 / 10


def test_size_counts_texts_and_doubts_large_tables(spark, frame):
    texts = Sized.of(frame("a long, b string", (1, "abc"), (2, None)))
    assert (texts.rows, texts.bytes) == (2, 35)
    assert texts.fits() and not texts.fits(34)
    many = Sized.of(spark.range(10).select(F.lit("x").alias("s")), rows=BROADCAST_BYTES)
    assert not many.fits()


# -- dedupe ---------------------------------------------------------------------------------------


def test_first_row_of_a_key_wins_whole(frame):
    df = frame(
        f"{UNION}, k string, status int",
        (0, 2, 1, "a", 20),
        (1, 1, 9, "a", None),
        (1, 1, 10, "b", 11),
        (0, 2, 2, "b", 22),
    )
    for row_id in (None, ("snapshot_id", "old_id")):
        kept = keyed_distinct(df, ["k"], [F.col("merge_rank"), F.col("old_id")], row_id)
        assert rows(kept, "k", "status") == [("a", None), ("b", 11)]


def test_null_in_a_key_is_never_a_duplicate(frame):
    df = frame(f"{UNION}, k string, j int", (0, 1, 1, None, 1), (0, 1, 2, None, 1), (0, 1, 3, "a", None), (1, 2, 1, "a", None))
    for row_id in (None, ("snapshot_id", "old_id")):
        assert keyed_distinct(df, ["k", "j"], [F.col("merge_rank"), F.col("old_id")], row_id).count() == 4


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("1 as snapshot_id", "id as old_id", "id % 10 as k")
    kept = keyed_distinct(df, ["k"], [F.col("old_id")], ("snapshot_id", "old_id"))
    text = plan(kept)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_a_key_travels_twice_only_if_it_is_compared_as_another_type(frame):
    df = frame(f"{UNION}, k string, j int", (0, 0, 1, "a", 1), (1, 1, 1, "a", 1), (1, 1, 2, None, 1), (0, 0, 2, "A", 1))
    for row_id in (None, ("snapshot_id", "old_id")):
        order = [F.col("merge_rank"), F.col("old_id")]
        plain = keyed_distinct(df, ["k", "j"], order, row_id)
        cast = keyed_distinct(df, ["k", "j"], order, row_id, {"k": "binary", "other": "binary"})
        assert "_p" not in plan(plain) and "_p0" in plan(cast) and "_p1" not in plan(cast)
        assert rows(plain) == rows(cast) == [(0, 0, 1, "a", 1), (0, 0, 2, "A", 1), (1, 1, 2, None, 1)]
        assert plain.columns == cast.columns == df.columns


def test_null_group_is_one_group_for_top1(frame):
    df = frame("_id long, j string, n long", (1, None, 5), (2, None, 9), (3, "a", None), (4, "a", 1), (5, "b", 2), (6, "b", 2))
    top = first_per_key(df, ["j"], [F.desc_nulls_last("n"), F.col("_id")])
    assert rows(top, "_id") == [(2,), (4,), (5,)]


def test_several_unique_keys_as_if_rows_were_added_one_by_one(spark, staging):
    import random

    random.seed(5)
    data = [
        (1, i, random.choice([None, *range(12)]), random.choice([None, *range(12)]), random.randrange(4))
        for i in range(60)
    ]
    seen_a, seen_b, want = set(), set(), []
    for r in sorted(data, key=lambda r: (r[4], r[1])):
        if (r[2] is not None and r[2] in seen_a) or (r[3] is not None and r[3] in seen_b):
            continue
        want.append(r[1])
        seen_a.add(r[2]), seen_b.add(r[3])
    df = spark.createDataFrame(data, "snapshot_id int, old_id long, a int, b int, merge_rank int")
    got = distinct_on_all(df, [["a"], ["b"]], ["merge_rank", "old_id"], ["snapshot_id", "old_id"], staging, "t")
    assert [r[0] for r in rows(got, "old_id")] == sorted(want)


def test_a_key_within_another_decides_alone(spark, staging):
    assert deciding([["a", "b"], ["b"], ["c", "a"], ["a", "c"], ["b"]]) == [["b"], ["c", "a"]]
    data = [(i, i % 7 or None, i % 3 or None, -i) for i in range(60)]
    df = spark.createDataFrame(data, "old_id long, a int, b int, rank int")
    seen, want = set(), []
    for old, a, _, rank in sorted(data, key=lambda r: r[3]):
        if a is None or a not in seen:
            want.append(old)
            seen.add(a)
    got = distinct_on_all(df, [["a", "b"], ["a"]], ["rank"], ["old_id"], staging, "t")
    # One shuffle and no rounds.
    assert sorted(r[0] for r in rows(got, "old_id")) == sorted(want) and got.columns == df.columns
    assert not Path(staging.root.removeprefix("file:")).exists()


# -- ids ------------------------------------------------------------------------------------------


def test_ids_follow_the_order_even_with_one_hot_time(spark, staging):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).selectExpr("if(id % 3 = 0, 5, id % 40) as timestamp", "id % 3 as merge_rank", "id as old_id")
        placed, n = assign_ordered_ids(df, ["timestamp", "merge_rank", "old_id"], staging, "t")
        got = [tuple(r) for r in placed.orderBy("_id").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert n == 3000
    assert [r[3] for r in got] == list(range(1, 3001))
    assert [r[:3] for r in got] == sorted(r[:3] for r in got)


def test_ids_of_no_rows(spark, staging):
    placed, n = assign_ordered_ids(spark.range(0).withColumnRenamed("id", "a"), ["a"], staging, "t")
    assert n == 0 and placed.collect() == []


def test_numbers_within_groups(spark, staging):
    df = spark.range(500).selectExpr("if(id % 3 = 0, 1, id % 7) as g", "id")
    got = number_within(df, ["g"], ["id"], staging, "t").collect()
    groups = {}
    for r in sorted(got, key=lambda r: r["id"]):
        groups.setdefault(r["g"], []).append(r["_rn"])
    assert len(got) == 500
    assert all(v == list(range(1, len(v) + 1)) for v in groups.values())


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_numbers_within_groups_that_ranges_and_batches_cut(spark, staging, batch):
    before = {c: spark.conf.get(c) for c in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    # One group over several ranges, groups of one row, a key of two columns, numbers that are none, and nulls.
    df = spark.range(900).selectExpr(
        "case when id < 500 then 'hot' when id % 50 = 0 then null else concat('k', id % 90) end as g",
        "case when id % 3 = 0 then double('nan') when id % 3 = 1 then 0.0D else -0.0D end as h",
        "id",
    )
    for c, v in zip(before, (batch, "9", "false")):
        spark.conf.set(c, v)
    try:
        numbered = number_within(df, ["g", "h"], ["id"], staging, "t")
        got = numbered.collect()
        cut = spark.read.parquet(f"{staging.root}/t").where("g = 'hot'").select("_part").distinct().count()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    groups = {}
    for r in sorted(got, key=lambda r: r["id"]):
        groups.setdefault((r["g"], r["h"] != r["h"]), []).append(r["_rn"])
    assert numbered.columns == ["g", "h", "id", "_rn"] and cut > 2
    assert len(got) == df.where("g is not null").count()
    assert all(v == list(range(1, len(v) + 1)) for v in groups.values())


def test_numbers_within_no_groups(spark, staging):
    assert number_within(spark.range(0).selectExpr("id as g", "id"), ["g"], ["id"], staging, "t").collect() == []


# -- align and rank -------------------------------------------------------------------------------


def test_align_fills_drops_and_converts(frame):
    base = frame("_id long, name string, n int, extra string").schema
    df = frame("_id int, n string, name string, gone int", (1, "5", "a", 0), (2, "x", "b", 0))
    got = align(df, base, {"extra": "d"})
    assert got.columns == ["old_id", "name", "n", "extra"]
    assert rows(got) == [(1, "a", 5, "d"), (2, "b", None, "d")]
    assert rows(cast_losses(df, base)) == [("n", 1)]
    assert lossy_columns(df.schema, base) == ["n"]
    assert common_columns(df.columns, base.names) == ["n", "name"]


def test_id_is_copied_if_it_is_not_first(frame):
    base = frame("name string, _id long").schema
    got = align(frame("name string, _id long", ("a", 7)), base, renumber=False)
    assert rows(got) == [(7, "a", 7)]
    assert common_columns(["name", "_id"], base.names) == ["name", "_id"]
    assert common_columns(["_id", "x"], ["_id", "name"]) == []


def test_base_and_merge_order_break_ties_differently(spark, frame):
    messages = frame("snapshot_id int, timestamp long", (0, 9), (1, 9), (2, 3))
    ranked = rank_snapshots(spark, ["b", "a", "c"], messages)
    assert [r.path for r in ranked] == ["a", "b", "c"]
    assert [r.path for r in ranked if r.is_base] == ["b"]


@pytest.mark.parametrize("bad", [[], [(1, None)], [(1, -5)]])
def test_unusable_snapshots_stop_the_run(spark, bad):
    messages = spark.createDataFrame([(0, 9), *bad], "snapshot_id int, timestamp long")
    with pytest.raises(InvalidSnapshot, match="second"):
        rank_snapshots(spark, ["first", "second"], messages)


def test_no_time_above_zero(spark, frame):
    with pytest.raises(InvalidSnapshot):
        rank_snapshots(spark, ["a"], frame("snapshot_id int, timestamp long", (0, 0)))


# -- remap and checks -----------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [None, 0])
def test_remap(frame, limit):
    maps = {
        "jid": Sized.of(frame("snapshot_id int, old_id long, new_id long", (0, 1, 10), (1, 1, 11))),
        "message": Sized.of(frame("snapshot_id int, old_id long, new_id long", (0, 5, 50))),
    }
    df = frame(
        f"{UNION}, sender_jid_row_id long, message_row_id long, note string, label_id long",
        (0, 1, 1, 1, 5, "a", 1),
        (1, 2, 2, 1, 5, "b", 1),
        (1, 2, 3, 9, None, "c", 1),
        (0, 1, 4, None, 5, "d", None),
    )
    got = remap(df, "some_table", maps, limit=limit, row=ROW)
    assert got.columns == df.columns
    want = [(1, 10, 50, "a", None), (2, 11, None, "b", None), (3, None, None, "c", None), (4, None, 50, "d", None)]
    assert rows(got, "old_id", "sender_jid_row_id", "message_row_id", "note", "label_id") == want
    sentinel = remap(df, "message", maps, limit=limit)
    assert [r[1] for r in rows(sentinel, "old_id", "sender_jid_row_id")] == [10, 11, 0, 0]


def test_nulls_are_split_off(frame):
    good, bad = split_nulls(frame("a int, b int", (1, None), (None, 2), (3, 4)), ["a", "b", "absent"])
    assert rows(good) == [(3, 4)] and bad.count() == 2
    good, bad = split_nulls(frame("a int", (None,)), [])
    assert good.count() == 1 and bad.count() == 0


def test_repeated_key_is_named(frame):
    df = frame("k string, v int", ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2))
    assert rows(duplicates(df, ["k"])) == [("a", 2)]
    with pytest.raises(DuplicateKey, match="t: repeated key: k='a'"):
        assert_unique(df, ["k"], "t")
    assert_unique(df, ["k", "v"], "t")


@pytest.mark.parametrize("table", ["missed_call_logs", "anything"])
def test_many_references_by_one_join_equal_one_join_each(spark, table, monkeypatch):
    monkeypatch.setattr("sediment.operators.lookup.TASK_ROWS", 50)
    r = random.Random(3)
    ids = lambda: r.choice([None, *range(1, 12)])
    columns = ("snapshot_id int, old_id long, a_jid_row_id long, b_jid_row_id long, x_chat_row_id long, y_message_row_id int, v string")
    df = spark.createDataFrame([(r.randrange(2), i, 1 if r.random() < 0.5 else ids(), ids(), ids(), ids(), f"v{i}") for i in range(300)], columns)
    mapped = lambda n: spark.createDataFrame([(s, i, i * n + s) for s in range(2) for i in range(1, 9)], "snapshot_id int, old_id long, new_id long")
    maps = {t: Sized.of(mapped(n)) for t, n in (("jid", 10), ("chat", 100), ("message", 1000))}
    small = remap(df, table, maps, row=ROW)
    large = remap(df, table, maps, row=ROW, limit=0)
    assert large.columns == small.columns and rows(large) == rows(small)
    # Only the chats are broadcast.
    limit = maps["chat"].bytes
    big = {t: Sized(m.df, m.rows, m.bytes + (t != "chat")) for t, m in maps.items()}
    assert rows(remap(df, table, big, row=ROW, limit=limit)) == rows(small)

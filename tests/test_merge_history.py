"""Merges and SCD2: NULL keys, duplicates, unchanged columns, idempotence."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sedimart.operators.history import scd2_apply, scd2_close, scd2_current, scd2_increment
from sedimart.operators.merge import insert_ignore, merge_conditional, merge_insert_only, update_from, upsert

SCHEMA = "k int, v string, created string"


def table(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_insert_only_keeps_duplicates_and_null_keys(spark):
    target = table(spark, [(1, "a", "x"), (None, "n", "x")])
    source = table(spark, [(1, "b", "y"), (2, "c", "y"), (2, "c", "y"), (None, "n", "y")])
    out = rows(merge_insert_only(target, source, ["k"]))
    assert out == [(None, "n", "x"), (None, "n", "y"), (1, "a", "x"), (2, "c", "y"), (2, "c", "y")]


def test_insert_ignore_adds_each_key_once(spark):
    out = insert_ignore(table(spark, [(1, "a", "x")]), table(spark, [(2, "c", "y"), (2, "c", "y"), (1, "z", "y")]), ["k"])
    assert rows(out) == [(1, "a", "x"), (2, "c", "y")]


def test_upsert_keeps_columns_outside_the_set_list(spark):
    target = table(spark, [(1, "a", "old"), (3, "c", "old")])
    source = table(spark, [(1, "b", "new"), (2, "d", "new"), (None, "e", "new")])
    once = upsert(target, source, ["k"], ["v"])
    assert rows(once) == [(None, "e", "new"), (1, "b", "old"), (2, "d", "new"), (3, "c", "old")]
    known = source.filter("k is not null")
    again = upsert(upsert(target, known, ["k"], ["v"]), known, ["k"], ["v"])
    assert rows(again) == rows(upsert(target, known, ["k"], ["v"]))


def test_upsert_with_repeated_key(spark):
    target, source = table(spark, [(1, "a", "x")]), table(spark, [(1, "c", "y"), (1, "b", "y")])
    with pytest.raises(Exception, match="repeats key"):
        upsert(target, source, ["k"], ["v"]).collect()
    assert rows(upsert(target, source, ["k"], ["v"], [F.col("v")])) == [(1, "b", "x")]


def test_update_from_leaves_others(spark):
    target = table(spark, [(1, "a", "x"), (2, "b", "x"), (None, "n", "x")])
    source = spark.createDataFrame([(1, "z"), (2, "y"), (None, "q")], "k int, v string")
    out = update_from(target, source, ["k"], {"v": lambda old, new: F.concat(old, new)}, where=F.col("k") < 2)
    assert rows(out) == [(None, "n", "x"), (1, "az", "x"), (2, "b", "x")]


def test_merge_conditional_margins(spark):
    schema = "c string, d string, n int"
    target = spark.createDataFrame([("a", "1", 5), ("a", "all", 5)], schema)
    source = spark.createDataFrame([("a", "1", 3), ("a", "all", 9), ("all", "all", 9), ("b", "1", 1)], schema)
    out = merge_conditional(
        target, source, ["c", "d"], {"n": F.greatest},
        matched_if=lambda c: (c("c") != "all") & (c("d") != "all"),
        insert_if=lambda c: ~((c("c") == "all") & (c("d") == "all")),
    )
    assert rows(out) == [("a", "1", 5), ("a", "all", 5), ("b", "1", 1)]


def test_small_source_is_broadcast_and_target_not_shuffled(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")).write.parquet(str(tmp_path / "t"))
    spark.range(10).select(F.col("id").cast("int").alias("k"), F.lit("b").alias("v")).write.parquet(str(tmp_path / "s"))
    target, source = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    text = plan(update_from(target, source, ["k"], {"v": lambda old, new: new}))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.fixture
def spread_out(spark):
    """Small partitions stay apart, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_merge_and_upsert_read_and_shuffle_each_side_once(spark, spread_out, tmp_path):
    for name, n, v in (("t", 1000, "a"), ("s", 300, "b")):
        spark.range(n).select(F.when(F.col("id") % 3 > 0, F.col("id")).cast("int").alias("k"), F.lit(v).alias("v")).write.parquet(str(tmp_path / name))
    target, source = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    merged = merge_conditional(target, source, ["k"], {"v": lambda old, new: new}, insert_if=lambda c: c("v") == "b")
    for out in (merged, upsert(target, source, ["k"], ["v"]), upsert(target, source, ["k"], ["v"], [F.col("v")])):
        text = plan(out)
        assert text.count("Exchange") == 1 and text.count("FileScan") <= 2 and "Join" not in text
        # rows without a key are all kept, and lie in more than one task
        assert out.filter("k is null").count() == 334 + 100
        assert out.filter("k is null").select(F.spark_partition_id().alias("p")).distinct().count() > 1
        assert out.filter("k is not null and v = 'b'").count() == 200 and out.count() == 1100


D = datetime.date
HIST = "k int, a string, b string, valid_from_dt date, valid_to_dt date"
HISTORY = [
    (1, "same", None, D(2024, 1, 1), None),
    (2, "old", "x", D(2024, 1, 1), None),
    (3, "gone", "x", D(2024, 1, 1), None),
    (4, "first", "x", D(2023, 1, 1), D(2024, 1, 1)),
    (4, "second", "x", D(2024, 1, 1), None),
]
SNAPSHOT = [(1, "same", None), (2, "new", "x"), (4, "first", "x"), (5, "fresh", "x")]


def test_scd2_contract(spark):
    hist, snap = spark.createDataFrame(HISTORY, HIST), spark.createDataFrame(SNAPSHOT, "k int, a string, b string")
    day = D(2024, 2, 1)
    done = scd2_apply(hist, snap, "k", ["a", "b"], "2024-02-01")
    assert rows(done) == sorted(
        [
            HISTORY[0],
            (2, "old", "x", D(2024, 1, 1), day),
            (2, "new", "x", day, None),
            (3, "gone", "x", D(2024, 1, 1), day),
            HISTORY[3],
            (4, "second", "x", D(2024, 1, 1), day),
            (4, "first", "x", day, None),
            (5, "fresh", "x", day, None),
        ],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )
    steps = scd2_increment(scd2_close(hist, snap, "k", ["a", "b"], "2024-02-01"), snap, "k", "2024-02-01")
    assert rows(steps) == rows(done)
    for later in ("2024-02-01", "2024-03-01"):
        assert rows(scd2_apply(done, snap, "k", ["a", "b"], later)) == rows(done)
    assert scd2_current(done).groupBy("k").count().filter("count > 1").count() == 0


def test_scd2_rows_without_a_key(spark, spread_out):
    """A third of the keys is NULL: such rows are told apart by content, and no task holds them all."""
    day = D(2024, 1, 1)
    hist = spark.createDataFrame([(None if i % 3 == 0 else i, f"a{i}", "x", day, None) for i in range(300)] + [(None, None, None, day, None)] * 40, HIST)
    rows_now = [(None if i % 3 == 0 else i, f"a{i}", "x" if i % 2 else "y") for i in range(300)] + [(None, None, None)] * 70
    snap = spark.createDataFrame(rows_now, "k int, a string, b string")
    done = scd2_apply(hist, snap, "k", ["a", "b"], "2024-02-01")
    assert done.filter("k is null and valid_to_dt is null and a is null").count() == 40
    assert done.filter("k is null and valid_to_dt = date '2024-02-01'").count() == 50
    assert done.filter("k is null and valid_from_dt = date '2024-02-01'").count() == 50
    assert done.filter("k is not null").count() == 300
    assert rows(scd2_apply(done, snap, "k", ["a", "b"], "2024-03-01")) == rows(done)
    stepped = scd2_increment(scd2_close(hist, snap, "k", ["a", "b"], "2024-02-01"), snap, "k", "2024-02-01")
    assert rows(stepped) == rows(done)
    spread = done.filter("k is null").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert spread[0] < spread[1] / 2


def test_scd2_as_written_quirks(spark):
    hist, snap = spark.createDataFrame(HISTORY, HIST), spark.createDataFrame(SNAPSHOT, "k int, a string, b string")
    out = rows(scd2_apply(hist, snap, "k", ["a", "b"], "2024-02-01", compat=True))
    day = D(2024, 2, 1)
    assert (None, None, None, day, None) in out  # the deleted key adds an all-NULL row
    assert (4, "second", "x", D(2024, 1, 1), None) in out  # the reverted key keeps the wrong version open
    assert (1, "same", None, D(2024, 1, 1), day) in out  # a NULL under '=' closes an unchanged row
    assert (1, "same", None, day, None) in out

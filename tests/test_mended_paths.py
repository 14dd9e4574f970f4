"""Inputs that once gave wrong rows or a crash: repeated keys, blank starts, unknown bodies, empty reruns, deep pages."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sedimart.catalog import QUERIES
from sedimart.functions.columns import like_built
from sedimart.functions.jsontext import payload_array
from sedimart.operators import linking
from sedimart.operators.aggregates import eav_pivot
from sedimart.operators.history import scd2_apply, scd2_close, scd2_current
from sedimart.operators.html import html_lessons, page_lessons
from sedimart.operators.merge import merge_conditional, update_from, upsert
from sedimart.operators.people import person_facts
from sedimart.operators.snapshots import calendar_expand, dated_events, lesson_times, page_diff, snapshot_diff
from sedimart.sources.crypto import decrypt, mirror_encrypted
from sedimart.sources.tables import append_snapshot, full_refresh, read_version, versions

KV = "k int, v string"
HIST = "k int, v string, valid_from_dt date, valid_to_dt date"


def test_the_row_with_a_key_is_mirrored(spark):
    src = spark.createDataFrame([(1, 7, "a"), (1, 8, "b"), (1, 9, "c")], "id int, owner int, v string")
    keys = spark.createDataFrame([(8, "AAAAAAAAAAAAAAAAAAAAAA=="), (9, "AAAAAAAAAAAAAAAAAAAAAA==")], "id int, key string")
    sealed = mirror_encrypted(src, keys, ["v"], "owner")
    assert rows(decrypt(sealed, keys, ["v"], "owner")) == [(1, 8, "b")]


def test_repeated_source_keys_never_multiply_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    source = spark.createDataFrame([(1, "y"), (1, "x"), (3, "c"), (3, "c")], KV)
    assert rows(update_from(target, source, ["k"], {"v": lambda old, new: new})) == [(1, "x"), (2, "b")]
    with pytest.raises(Exception, match="repeats key"):
        merge_conditional(target, source, ["k"], {"v": lambda old, new: new}).count()
    once = merge_conditional(target, source.filter("v != 'x'"), ["k"], {"v": lambda old, new: new})
    assert rows(once) == [(1, "y"), (2, "b"), (3, "c"), (3, "c")]


def test_a_count_does_not_drop_the_check_of_upsert(spark):
    target, source = spark.createDataFrame([(1, "a")], KV), spark.createDataFrame([(1, "c"), (1, "b")], KV)
    with pytest.raises(Exception, match="repeats key"):
        upsert(target, source, ["k"], ["v"]).count()


def test_histories_keep_one_open_version_per_key(spark):
    day = datetime.date(2024, 1, 1)
    hist = spark.createDataFrame([(1, "a", day, None), (2, "b", day, None)], HIST)
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (3, "c")], KV)
    assert len(rows(scd2_close(hist, twice, "k", ["v"], "2024-02-01"))) == 2
    after = scd2_apply(hist, twice, "k", ["v"], "2024-02-01")
    assert rows(scd2_current(after), "k", "v") == [(1, "a"), (3, "c")]
    assert rows(scd2_apply(after, twice, "k", ["v"], "2024-02-02")) == rows(after)
    with pytest.raises(Exception, match="repeats key"):
        scd2_apply(hist, spark.createDataFrame([(1, "a"), (1, "b")], KV), "k", ["v"], "2024-02-01").collect()


def test_payload_arrays_may_begin_with_any_blank(spark):
    texts = spark.createDataFrame([('\n[{"a":1},{"a":2}]',), ("\t[]",), (' \r\n{"a":3}',)], "t string")
    assert sorted(r.n for r in texts.select(F.size(payload_array("t")).alias("n")).collect()) == [0, 1, 2]


def test_pages_with_unknown_bodies_are_changed(spark):
    old = spark.createDataFrame([("a", None), ("b", None), ("c", "x"), ("d", "x"), ("e", "x")], "url string, body string")
    new = spark.createDataFrame([("a", None), ("b", "y"), ("c", None), ("d", "x"), ("f", None)], "url string, body string")
    assert rows(page_diff(new, old, "url", "body")) == [("a", "changed"), ("b", "changed"), ("c", "changed"), ("e", "removed"), ("f", "added")]


def test_deleted_rows_without_first_key_are_deleted(spark):
    schema = "id int, subject string, place array<int>, extra int"
    old, new = spark.createDataFrame([(1, None, [1], 0)], schema), spark.createDataFrame([], schema)
    assert rows(snapshot_diff(old, new, ["subject"], ["place"], ["extra"]), "action") == [("delete",)]
    assert rows(snapshot_diff(old, new, ["subject"], ["place"], ["extra"], compat=True), "action") == [("create",)]


def test_an_empty_rerun_empties_its_day(spark, tmp_path):
    df, path = spark.createDataFrame([(1, "a")], KV), str(tmp_path / "snaps")
    append_snapshot(df, path, "2024-01-01")
    append_snapshot(df, path, "2024-01-02")
    left = append_snapshot(df.filter("false"), path, "2024-01-02")
    assert rows(left.select("k", "v", F.col("state_dt").cast("string"))) == [(1, "a", "2024-01-01")]


def test_patterns_with_escaped_backslashes(spark):
    pairs = spark.createDataFrame([("x c:\\a y", "c:\\\\a"), ("50% off", "50\\% o"), ("abc", "a\\bc"), ("a\\b", "a\\\\\\b")], "t string, p string")
    assert [r.hit for r in pairs.select(like_built("t", "p").alias("hit")).collect()] == [True, True, True, True]


def test_deeply_nested_pages_do_not_end_the_job(spark):
    deep = "<html><body><table><tr></tr><tr>" + "<td>" * 3000 + "</tr></table></body></html>"
    assert page_lessons(deep) == []
    pages = spark.createDataFrame([("u", deep)], "url string, raw_html string")
    good, bad = html_lessons(pages, on_error="reject")
    assert good.count() == 0 and bad.count() == 0


def test_a_third_refresh_leaves_two_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (1, 2, 3):
        full_refresh(spark.range(n), root)
    assert versions(spark, root) == [2, 3]
    assert [read_version(spark, root, back).count() for back in (0, 1)] == [3, 2]


def test_dates_of_lessons_are_never_broadcast(spark, tmp_path):
    schema = "id bigint, subject string, teacher array<int>, group array<int>, place array<bigint>, weekday int, odd boolean, even boolean, start string, end string"
    lessons = [(1, "a", [1], [1], [1], 2, True, True, "9:00", "10:35"), (2, "b", [1], [1], [2], 2, False, False, "9:00", "10:35")]
    spark.createDataFrame(lessons, schema).write.parquet(str(tmp_path / "weekly"))
    weekly = spark.read.parquet(str(tmp_path / "weekly"))  # files have a size that Spark knows
    dated = lesson_times(calendar_expand(weekly, "1995-02-08", "1995-02-20", "1995-02-07"))
    events = dated_events(weekly, dated)
    assert "SortMergeJoin" in plan(events) and "Broadcast" not in plan(events)
    shown = events.select("id", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"))
    assert rows(shown) == [(1, "1995-02-08 09:00"), (1, "1995-02-15 09:00"), (2, None)]


def test_rows_that_share_a_name_meet_a_text_once(spark, monkeypatch):
    texts = spark.createDataFrame([(1, "a red bolt"), (2, "a blue ring"), (3, "none"), (4, None)], "lid int, text string")
    many = [(f"{i:03}", name) for i, name in enumerate(["red", "Red", "re", "ring", None] * 40)]
    names = spark.createDataFrame([*many, (None, "blue")], "rid string, name string")
    met = []
    whole = linking.contains_join
    monkeypatch.setattr(linking, "contains_join", lambda left, right, *rest: met.append(right) or whole(left, right, *rest))
    assert rows(linking.link_best(texts, names, "lid", "text", "rid", "name")) == [(1, "000"), (2, None)]
    assert rows(met[0], "name", "rid") == [(None, "004"), ("Red", "001"), ("blue", None), ("re", "002"), ("red", "000"), ("ring", "003")]


def test_the_typed_refresh_tells_whether_times_moved(spark, tmp_path):
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    orders = [(1, 7, "O", 1.0, datetime.datetime(1996, 1, 10), "5-LOW"), (2, 7, "O", 1.0, None, "5-LOW")]
    spark.createDataFrame(orders, schema).write.parquet(str(tmp_path / "orders.parquet"))
    done = QUERIES["typed_refresh"](spark, str(tmp_path))
    assert rows(done, "api_id", "moved", "start_ts") == [(1, True, "1996-01-10 03:00:00.000000"), (2, None, None)]


def test_facts_stay_where_they_are_read(spark, tmp_path):
    facts = [(1, 0, 1, "a"), (1, 0, 2, "b"), (2, 5, 1, "c"), (3, 0, 9, "d"), (4, None, 1, "e")]
    spark.createDataFrame(facts, "owner_id int, param_id int, source_id int, value string").write.parquet(str(tmp_path / "info"))
    info = spark.read.parquet(str(tmp_path / "info"))  # files have a size that Spark knows, unlike the lists
    param = spark.createDataFrame([(0, "sex")], "id int, name string")
    source = spark.createDataFrame([(1, "user"), (2, "admin")], "id int, name string")
    named = person_facts(info, param, source)
    assert plan(named).count("BroadcastHashJoin") == 2 and "BuildLeft" not in plan(named) and "SortMergeJoin" not in plan(named)
    assert rows(named) == [(1, "sex", "a", "user"), (1, "sex", "b", "admin"), (2, None, "c", "user"), (4, None, "e", "user")]


def test_cells_are_dealt_by_owner_before_rows_are_wide(spark):
    facts = spark.createDataFrame([(1, "a", "y"), (1, "a", "x"), (1, "b", "z"), (2, "c", "n"), (None, "a", "w")], "o int, n string, v string")
    wide = eav_pivot(facts, "o", "n", "v", {"a": "a", "b": "b"})
    assert plan(wide).count("Exchange hashpartitioning") == 2 and "REPARTITION_BY_COL" in plan(wide)
    assert rows(wide) == [(None, "w", None), (1, "x, y", "z"), (2, None, None)]

"""Payloads, logs, cubes, pivots, ranks, ratings, landing, sinks and outbound tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sedimart.functions.columns import guarded_int, shift_zone
from sedimart.operators.aggregates import eav_pivot, labelled_cube, shrunk_mean
from sedimart.operators.logs import attach_container, parse_log, parse_processes
from sedimart.operators.outbound import membership_changes, pending_digest, printer_list
from sedimart.operators.payloads import explode_payload
from sedimart.operators.people import resolve_ids
from sedimart.operators.quality import column_list, schema_drift
from sedimart.operators.ranking import batch, best_per_group, completeness_dedupe, global_rank
from sedimart.plans.infra import incident_history, log_cube, merge_log_cube
from sedimart.plans.marketing import action_tables
from sedimart.plans.rating import ods_lecturer
from sedimart.plans.timetable import dim_group, link_table
from sedimart.sources.crypto import decrypt, generate_keys, mirror_encrypted
from sedimart.sources.landing import flatten_json, mirror_table
from sedimart.sources.tables import append_snapshot, full_refresh, read_version, replace_slice, retain, rotate_snapshot, versions

T = datetime.datetime


def test_explode_payload_forms(spark):
    texts = ["", "{}", "[]", '[{"a":1},{"a":2}]', '{"a":3}', None, "12"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, t string")
    out = explode_payload(df, "t").select("id", F.variant_get("elem", "$.a", "string").alias("a"))
    assert rows(out) == [(0, None), (1, None), (3, "1"), (3, "2"), (4, "3"), (5, None), (6, None)]
    bad = df.unionByName(spark.createDataFrame([(9, "{broken")], "id int, t string"))
    with pytest.raises(Exception):
        explode_payload(bad, "t").collect()
    good, rejects = explode_payload(bad, "t", on_error="reject")
    assert good.count() == 7 and [r.id for r in rejects.collect()] == [9]


def test_action_tables(spark):
    ts = T(2024, 1, 1)
    data = [
        (5, "go", "a", "b", '{"user_agent": "Bot x"}', ts), (-1, "p", "a", "b", '{"status": "ok"}', ts),
        (-2, "q", "a", "b", '[{"pin": "12", "status_code": 200}, {"pin": "x"}]', ts), (-2, None, "a", "b", "{}", ts),
        (-3, "r", "a", "b", '{"auth_user_id": "Not auth"}', ts), (-3, "r", "a", "b", '{"auth_user_id": "7", "response_status_code": 404}', ts),
    ]
    raw = spark.createDataFrame(data, "user_id int, action string, path_from string, path_to string, additional_data string, create_ts timestamp_ntz")
    out = action_tables(raw)
    assert rows(out["frontend_actions"], "user_id", "user_agent", "is_bot") == [(5, "Bot x", True)]
    assert out["frontend_actions"].first().create_ts == T(2024, 1, 1, 3)
    assert rows(out["printer_actions"], "status", "app_version") == [("ok", "")]
    assert rows(out["printer_bots_actions"], "pin", "status_code") == [(0, None), (12, 200)]
    assert rows(out["rating_actions"], "response_status_code", "user_id") == [(0, 0), (404, 7)]


def test_guarded_int_and_zone(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(guarded_int("t", 0)).collect()] == [12, 0, 0]
    one = spark.range(1).select(shift_zone(F.lit("2012-06-01 00:00:00"))).first()[0]
    assert one == T(2012, 6, 1, 4)  # Moscow was four hours ahead that year


def test_parse_and_attach_logs(spark):
    ts = T(2024, 1, 1)
    path = "/var/abcdef0123456789/x.log"
    data = [
        (1, '{"log":"{\\"timestamp\\": \\"2023-05-05T01:02:03\\", \\"message\\": \\"m\\"}"}', path, ts),
        (2, '{"log":"{\\"level_name\\": \\"ERROR\\", \\"message\\": \\"e\\"}"}', path, ts),
        (3, '{"log":"plain \\u0000 text"}', path, ts), (4, "not json", path, ts), (5, '{"log":"short"}', "x.log", ts),
        (6, '{"log":"{\\"a\\": 1}"}', path, ts), (7, '{"log":"no process"}', "/var/ffff/x.log", ts),
    ]
    logs = parse_log(spark.createDataFrame(data, "id int, record string, logfile string, create_ts timestamp_ntz"))
    by_id = {r.id: r for r in logs.collect()}
    assert sorted(by_id) == [1, 2, 3, 6, 7]
    assert by_id[1].create_ts == T(2023, 5, 5, 1, 2, 3) and by_id[2].create_ts == ts
    assert by_id[3].record == '{"message":"plain  text"}' and by_id[6].record == '{"message":"{\\"a\\": 1}"}'
    lists = [(" abcdef::img::old::Up::2024-01-01 00:00:00 ^ ", T(2024, 1, 1)), (" abcdef::img::new::Up::2024-01-02 00:00:00 ^", T(2024, 1, 2))]
    processes = parse_processes(spark.createDataFrame(lists, "record string, create_ts timestamp_ntz"))
    named = attach_container(logs, processes)
    assert rows(named, "id", "container_name") == [(1, "new"), (2, "new"), (3, "new"), (6, "new")]
    empty = spark.createDataFrame([], "id string, msk_record_loaded_dttm timestamp_ntz, container_name string, message string, create_ts timestamp_ntz")
    once = incident_history(empty, named, "2024-01-01 00:00:00")
    assert rows(once, "container_name", "message") == [("new", "e")]
    assert incident_history(once, named, "2024-01-02 00:00:00").count() == 1


def test_cube_margins_and_merge(spark):
    data = [
        ("svc_a", '{"level_name": "error"}', T(2024, 1, 1)), ("svc_a", '{"loglevel": "odd"}', None),
        ("svc_b", '{"level_name": "INFO"}', T(2024, 1, 1)), ("other", '{"level_name": "INFO"}', T(2024, 1, 1)), ("svc_b", "{}", T(2024, 1, 1)),
    ]
    log = spark.createDataFrame(data, "container_name string, record string, create_ts timestamp_ntz")
    cube = log_cube(log, "svc_%")
    cells = {(r.container_name, r.create_date): r for r in cube.collect()}
    assert cells[("svc_a", None)].other_cnt == 1 and cells[("all", "all")].info_cnt == 1
    parts = [r for k, r in cells.items() if "all" not in k]
    assert sum(r.error_cnt for r in parts) == cells[("all", "all")].error_cnt == 1
    stored = merge_log_cube(cube.limit(0), cube.filter("create_date is not null"))
    assert ("all", "all") not in {(r.container_name, r.create_date) for r in stored.collect()}
    smaller = log_cube(log.filter("container_name = 'svc_b'"), "svc_%").filter("create_date is not null")
    assert rows(merge_log_cube(stored, smaller)) == rows(stored)


def test_cube_compat_reads_nulls_as_margin(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "d string, n int")
    out = labelled_cube(df, {"d": F.col("d")}, {"n": F.col("n")}, compat=True)
    assert rows(out) == [("a", 2), ("all", 1), ("all", 3)]


def test_eav_pivot(spark):
    data = [(1, "x", "b", "s"), (1, "x", "a", "s"), (1, "x", "a", "t"), (1, "zz", "q", "s"), (2, "zz", "q", "s"), (3, "y", None, "s")]
    df = spark.createDataFrame(data, "o int, n string, v string, src string")
    out = eav_pivot(df, "o", "n", "v", {"x": "ex", "y": "why"}, "src")
    assert rows(out, "o", "ex", "ex_source", "why", "why_source") == [(1, "a, b", "s, t", None, None), (2, None, None, None, None), (3, None, None, None, "s")]


def test_ranks_equal_plain_sort_under_ties(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, F.lit(5.0)).otherwise(F.col("id") % 7).alias("s"))
    df = df.withColumn("s", F.when(F.col("id") % 11 != 0, F.col("s"))).repartition(7)
    got = [r.id for r in global_rank(df, "s", ["id"]).orderBy("rank").collect()]
    data = [(r.id, r.s) for r in df.collect()]
    assert got == [i for i, s in sorted(data, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))]
    numbers = batch(df, [F.col("id")], 100).groupBy("batch_no").count()
    assert rows(numbers) == sorted([(i, 100) for i in range(20)], key=lambda r: (True, str(r[0])))


def test_first_row_filter_reaches_the_map_side(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    text = plan(best_per_group(df, ["k"], [F.col("id").desc()]))
    assert "WindowGroupLimit" in text and "Partial" in text
    scored = spark.createDataFrame([(1, "a", " "), (1, "b", "c")], "k int, x string, y string")
    assert rows(completeness_dedupe(scored, "k", ["x", "y"]), "x", "completeness_score") == [("b", 2)]


def test_shrunk_mean_by_hand(spark):
    lecturers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, last_name string").withColumns(
        {c: F.lit(None).cast("string") for c in ("first_name", "middle_name", "subject", "avatar_link", "timetable_id")}
    )
    comments = spark.createDataFrame([("u", 1, -3, -2, -2), ("v", 2, 2, 2, 2), ("w", None, 1, 1, 1)], "uuid string, lecturer_id int, mark_kindness int, mark_freebie int, mark_clarity int")
    out = {r.api_id: r for r in ods_lecturer(lecturers, comments).collect()}
    assert sorted(out) == [1, 2]
    assert out[1].mark_weighted == pytest.approx((-2 * 1 + (1 / 3) * 0.75) / 1.75)  # -7 / 3 counts as -2
    assert out[2].mark_kindness_weighted == pytest.approx((2 * 1 + 0 * 0.75) / 1.75)
    assert shrunk_mean(comments, "lecturer_id", {"m": F.col("mark_kindness")}).count() == 2


def test_dimension_and_links(spark):
    raw = spark.createDataFrame([(1, "A", "101", False), (2, "A", "101", False), (3, "B", "102", True), (4, "C", "103", None)], "id int, name string, number string, is_deleted boolean")
    dim = dim_group(raw, "api")
    assert rows(dim, "group_api_id", "group_name_text") == [(1, "101A")]
    again = {r.id for r in dim_group(raw, "api").collect()}
    assert again == {r.id for r in dim.collect()}
    events = spark.createDataFrame([("e1", "group 101"), ("e2", "none")], "id string, name string")
    assert [r.event_id for r in link_table(events, dim, "group_number", "group_id").collect()] == ["e1"]


def test_resolve_ids(spark):
    df = spark.createDataFrame([(1, ["b", "x", "a"]), (2, []), (3, None)], "id int, names array<string>")
    dim = spark.createDataFrame([(7, "a"), (5, "a"), (9, "b")], "rid int, name string")
    done, create = resolve_ids(df, "id", "names", dim, "name", "rid", -100)
    assert rows(done, "id", "names") == [(1, [9, -100, 5]), (2, []), (3, None)]
    assert rows(create) == [("x",)]


def test_mirror_and_flatten(spark):
    df = spark.sql("select 1 as id, named_struct('b', named_struct('c', 2), 'd', array(3)) as a, 'x' as gone")
    assert mirror_table(df, ["id", "a", "absent"]).first().asDict() == {"id": 1, "a": '{"b":{"c":2},"d":[3]}'}
    assert flatten_json(df).columns == ["id", "a_b_c", "a_d", "gone"]


def test_keys_and_encryption(spark, tmp_path):
    users = spark.createDataFrame([(1,), (2,), (3,), (3,)], "id int")
    old = generate_keys(users.filter("id = 1"), spark.createDataFrame([], "id int, key string"))
    old = full_refresh(old, str(tmp_path / "k"))
    keys = full_refresh(generate_keys(users, old), str(tmp_path / "k"))
    assert keys.count() == 3 and keys.filter("id = 1").first().key == old.first().key
    src = spark.createDataFrame([(1, 1, "a"), (2, 3, "b"), (3, 9, "c")], "id int, owner_id int, value string")
    sealed = mirror_encrypted(src, keys, ["value"], "owner_id")
    assert sealed.count() == 2 and dict(sealed.dtypes)["value"] == "binary"
    assert rows(decrypt(sealed, keys, ["value"], "owner_id")) == [(1, 1, "a"), (2, 3, "b")]


def test_sinks(spark, tmp_path):
    root, snaps = str(tmp_path / "t"), str(tmp_path / "s")
    df = spark.range(3)
    full_refresh(df, root)
    doubled = full_refresh(read_version(spark, root).selectExpr("id * 2 as id"), root)
    assert rows(doubled) == [(0,), (2,), (4,)] and versions(spark, root) == [1, 2]
    current, previous = rotate_snapshot(spark.range(1), root)
    assert current.count() == 1 and previous.count() == 3
    for _ in range(2):
        append_snapshot(df, snaps, "2024-01-01")
    assert append_snapshot(df, snaps, "2024-01-02").count() == 6
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "s string, n int")
    assert rows(replace_slice(target, spark.createDataFrame([(9,)], "n int"), "s", "a")) == [(None, 3), ("a", 9), ("b", 2)]
    timed = spark.createDataFrame([(1, T(2024, 1, 1)), (2, T(2024, 1, 7)), (3, None)], "id int, ts timestamp_ntz")
    assert rows(retain(timed, "ts", "2024-01-09 00:00:00", 3), "id") == [(2,), (3,)]


def test_outbound(spark):
    members = spark.createDataFrame([(1,), (2,)], "user_id int")
    groups = spark.createDataFrame([(1, [22]), (2, [5]), (3, [22, 6])], "user_id int, groups array<int>")
    inside = spark.createDataFrame([(1,), (3,)], "user_id int")
    assert rows(membership_changes(members, groups, inside, 22)) == [(1, "add", [22]), (2, "add", [5, 22]), (3, "remove", [6])]
    people = [("B", "1", "Старый Физический факультет", "Член профсоюза"), ("A", "1", "физический факультет", "член профсоюза"), ("", "2", "физический факультет", "член профсоюза"), ("C", "3", "other", "член профсоюза")]
    listed = printer_list(spark.createDataFrame(people, "last_name string, card_number string, faculty string, status string"))
    assert rows(listed, "username", "union_number") == [("A", "1")]
    comments = spark.createDataFrame(
        [("a", 1, "s", "x" * 16, None, T(2024, 1, 2)), ("b", 9, "s", "y" * 17, 4, T(2024, 1, 2)), ("c", 1, "s", "z", 4, T(2023, 1, 1))],
        "uuid string, lecturer_id int, subject string, text string, user_id int, update_ts timestamp_ntz",
    )
    lecturers = spark.createDataFrame([(1, "Last", "First", "Mid")], "id int, last_name string, first_name string, middle_name string")
    users = spark.createDataFrame([(4, "Name")], "user_id int, full_name string")
    lines, totals = pending_digest(comments, lecturers, users, "2024-01-01 00:00:00", "2024-01-02")
    assert rows(lines, "uuid", "lecturer", "author", "short_text") == [("a", "LastF.M.", "Anonim", "x" * 16), ("b", None, "Name", "y" * 13 + "...")]
    assert totals.first().asDict() == {"total_today": 2, "total_unreviewed": 3}
    lines, totals = pending_digest(comments, lecturers, users, "2024-01-01 00:00:00", "2024-01-01")
    assert lines.count() == 0 and totals.first().total_today == 0


def test_schema_drift(spark):
    src = column_list(spark, {("api", "t"): ["a", "c", "b"], ("api", "alembic_version"): ["v"], ("unmapped", "t"): ["q"]})
    tgt = column_list(spark, {("STG", "t"): ["a", "z"]})
    out = rows(schema_drift(src, tgt, {"api": "STG"}))
    assert out == [("extra in target", "STG", "t", "z"), ("missing in target", "STG", "t", "b, c")]

"""Many-table merges, resolved lessons, factored rentals, gathered links, ranks and the other parts of the marts."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sedimart.operators.people import SATELLITES, change_set, created_id, merge_satellites, resolve_or_create, satellite_upsert
from sedimart.operators.quality import table_sizes
from sedimart.operators.ranking import global_rank, number_rows
from sedimart.operators.snapshots import require_pages
from sedimart.plans.rental import rentals, rentals_mart
from sedimart.plans.timetable import gathered_links, lessons_to_ids
from sedimart.session import stage, stages_that_go

ATTRIBUTES = sorted({c for s in SATELLITES for c in [*s.values.values(), s.source or "student_id"]} | {"student_id"})


def person(spark, *people):
    """Rows of the combined table with the given attributes; the rest are unknown."""
    return spark.createDataFrame([(p["user_id"], *[p.get(c) for c in ATTRIBUTES]) for p in people], "user_id long, " + ", ".join(f"`{c}` string" for c in ATTRIBUTES))


def attribute_table(spark, spec, *stored):
    columns = ", ".join(f"`{c}` string" for c in spec.values)
    made = spark.createDataFrame([(*values, user, source) for user, source, values in stored], f"{columns}, user_id int, source string")
    then = F.lit("2024-01-01").cast("timestamp")
    return made.withColumns({"created": then, "modified": then, "is_deleted": F.lit(False)})


def test_one_merge_equals_one_upsert_per_table(spark):
    specs = {s.table: s for s in SATELLITES}
    card = dict(card_id="7", card_status="ok", card_date="d", card_number="n", card_user="u")
    people = person(
        spark,
        dict(user_id=1, student_id="S1", student_id_source="user", faculty="Physics", faculty_source="user", status="member", status_gain_date="", status_source="m", **card),
        dict(user_id=2, student_id="S2", student_id_source="user", faculty=" ", faculty_source="user", rzd_number="R", rzd_status="x", rzd_datetime="t", rzd_number_source="m"),
        dict(user_id=3, student_id=" ", faculty="Chem", faculty_source="user", full_name_eng="Ann"),
    )
    stored = {
        "faculty": attribute_table(spark, specs["faculty"], (1, "old", ["Physics"]), (1, "old", ["Chem"]), (None, "old", ["Physics"]), (9, "old", [None])),
        "card": attribute_table(spark, specs["card"], (1, "old", ["7", "lost", "d", "n", "u"])),
        **{t: attribute_table(spark, specs[t]) for t in ("status", "rzd", "student_id", "full_name_eng")},
    }
    merged = merge_satellites(stored, people, "2024-02-01", SATELLITES)
    assert set(merged) == set(stored)
    for name, table in merged.items():
        assert table.dtypes == stored[name].dtypes
        assert rows(table) == rows(satellite_upsert(stored[name], people, specs[name], "2024-02-01"))
    assert rows(merged["faculty"], "user_id", "faculty", "source") == [(None, "Physics", "old"), (1, "Chem", "old"), (1, "Physics", "user"), (9, None, "old")]
    assert rows(merged["card"], "card_status") == [("ok",)] and merged["status"].count() == 1 and merged["full_name_eng"].count() == 0
    # every table's offers come out of one pass over the people
    assert plan(change_set(people, SATELLITES, "2024-02-01")).count("Scan") == 1
    again = merge_satellites(merged, people, "2024-02-01", SATELLITES)
    assert all(rows(again[t]) == rows(merged[t]) for t in merged)


def test_lessons_find_or_make_their_rows(spark):
    lessons = spark.createDataFrame(
        [(1, ["A1", "Z9"], ["101", "102", None], ["Ivanov I. P.", "Petrov Pavel Ivanovich"]), (2, [], ["102"], ["Petrov P. I."]), (3, None, None, [])],
        "id int, place array<string>, group array<string>, teacher array<string>",
    )
    rooms = spark.createDataFrame([(5, "A1"), (4, "A1")], "id long, name string")
    groups = spark.createDataFrame([(11, "101", "first")], "id long, number string, name string")
    lecturers = spark.createDataFrame([(21, "Igor", "Petrovich", "Ivanov", "x"), (22, None, None, None, None)], "id long, first_name string, middle_name string, last_name string, description string")
    done, lacking = lessons_to_ids(lessons, rooms, groups, lecturers)
    new_group, new_teacher = lacking["groups"].first(), lacking["lecturers"].first()
    got = {r.id: (r.place, r.group, r.teacher) for r in done.collect()}
    assert got == {1: ([4, -100], [11, new_group.id, None], [21, new_teacher.id]), 2: ([], [new_group.id], [new_teacher.id]), 3: (None, None, [])}
    assert rows(lacking["rooms"]) == [("Z9",)]
    assert (new_group.number, new_group.name) == ("102", "Группа # 102") and lacking["groups"].count() == 1
    assert tuple(new_teacher)[1:4] == ("P", "I", "Petrov") and lacking["lecturers"].count() == 1
    # a rerun finds what the first run made, and makes nothing
    after, none = lessons_to_ids(lessons, rooms, groups.unionByName(lacking["groups"]), lecturers.unionByName(lacking["lecturers"]))
    assert rows(after) == rows(done) and none["groups"].count() == none["lecturers"].count() == 0


def test_names_without_rows_or_keys(spark):
    df = spark.createDataFrame([(1, [None, "a"])], "id int, names array<string>")
    dim = spark.createDataFrame([], "rid long, name string")
    done, made = resolve_or_create(df, "id", "names", dim, F.col("name"), "rid", lambda n: n, lambda n: {"name": n})
    want = spark.range(1).select(created_id(F.lit("a")).alias("i")).first().i
    assert want > 0 and rows(done) == [(1, [None, want])] and rows(made) == [(want, "a")]
    empty, none = resolve_or_create(df.filter("false"), "id", "names", dim, F.col("name"), "rid", lambda n: n, lambda n: {"name": n})
    assert empty.count() == none.count() == 0


def test_rentals_are_factors_until_asked(spark):
    times = "reservation_ts, start_ts, end_ts, actual_return_ts".split(", ")
    sessions = spark.createDataFrame([("s1", 1, 5), ("s2", 2, 5), ("s3", None, 6)], "uuid string, user_id int, item_id int")
    sessions = sessions.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in times} | {c: F.lit(0) for c in ("admin_open_id", "admin_close_id")} | {"status": F.lit("x")})
    items = spark.createDataFrame([(5, 8)], "api_id int, type_id int")
    types = spark.createDataFrame([(8, "ball", None, None)], "api_id int, name string, image_url string, description string")
    events = spark.createDataFrame([(1, 7, i) for i in range(200)] + [(None, 7, 1)], "user_id int, session_id int, admin_id int")
    strikes = spark.createDataFrame([(1, f"r{i}", "d") for i in range(100)], "user_id int, reason string, create_ts string")
    mart = rentals_mart(sessions, items, types, events, strikes)
    assert rows(mart, "uuid", "name", "n_events", "n_strikes") == [("s1", "ball", 200, 100), ("s2", "ball", 0, 0), ("s3", None, 0, 0)]
    whole = rentals_mart(sessions, items, types, events, strikes, compat=True)
    assert whole.count() == 200 * 100 + 2 and "n_events" not in whole.columns
    assert whole.filter("uuid = 's1'").select("admin_strike_id", "strike_reason").distinct().count() == 20_000
    assert rentals(sessions, items, types, events, strikes).events.count() == 201


def test_links_are_gathered_in_one_aggregation(spark):
    link = lambda *pairs: spark.createDataFrame(list(pairs), "event_id string, value int")
    got = gathered_links({"a": link(("e1", 1), ("e1", 1), ("e2", 2)), "b": link(("e1", 5), (None, 6)), "c": link(("e3", None))})
    text = plan(got)
    assert text.count("Exchange") == 1 and "Join" not in text
    assert rows(got) == [("e1", 1, 5, None), ("e2", 2, None, None), ("e3", None, None, None)]
    with pytest.raises(Exception, match="repeat event e1"):
        gathered_links({"a": link(("e1", 1), ("e1", 2))}).count()


def test_ranked_tables_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).select((F.col("id") % 7).alias("score"), "id", F.lit("wide").alias("more")).mapInArrow(counted, "score long, id long, more string")
    got = global_rank(df, "score", ["id"])
    want = sorted(((-(i % 7), i) for i in range(1000)))
    assert [r.id for r in got.orderBy("rank").collect()] == [i for _, i in want] and got.columns == ["score", "id", "more", "rank"]
    assert seen.value == 1000
    assert number_rows(df.filter("false"), [F.col("id")]).count() == 0


def test_sizes_and_expected_pages(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "t"))
    [row] = table_sizes({("s", "t"): spark.read.parquet(str(tmp_path / "t"))}, "2024-01-01").collect()
    assert (row.n_rows, row.total_size_mb, row.indexes_size_mb) == (10, 0, 0)
    assert row.total_bytes == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    pages = spark.createDataFrame([("a",), ("b",)], "url string")
    assert require_pages(pages, spark.createDataFrame([("a",)], "url string")) is pages
    with pytest.raises(ValueError, match="1 pages are missing"):
        require_pages(pages, spark.createDataFrame([("a",), ("c",)], "url string"))


def test_stages_go_with_their_scope(spark, tmp_path):
    with stages_that_go(spark) as outer:
        kept = stage(spark.range(5))
        with stages_that_go(spark) as inner:
            ranked = number_rows(spark.range(7), [F.col("id")])
            ranked.write.parquet(str(tmp_path / "ranked"))
        assert not os.path.exists(inner) and os.path.exists(outer) and kept.count() == 5
    assert not os.path.exists(outer)
    assert spark.read.parquet(str(tmp_path / "ranked")).count() == 7
    assert os.path.exists(stage(spark.range(1)).inputFiles()[0].removeprefix("file:").removeprefix("//"))

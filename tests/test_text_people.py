"""Linking, name parts, person resolution, satellites, HTML, calendar, snapshots."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan, rows
from sedimart.functions.text import tokens, tokens_match
from sedimart.operators.html import html_lessons
from sedimart.operators.containment import contains_join, meetings, window_join
from sedimart.operators.joins import member_join
from sedimart.operators.linking import link_best, token_candidates
from sedimart.operators.people import SATELLITES, combine, member_table, name_parts, names_agree, person_facts, user_table
from sedimart.operators.snapshots import calendar_expand, page_diff, snapshot_diff
from sedimart.plans.userdata import refresh_satellites


def test_contains_join_equals_brute_force(spark):
    texts = ["Group 101 and 102M", "Ivanov I.I. 5-18", "100% sure", "", None, "a_b", "axb", "The long sentence has many words here", "back\\slash"]
    parts = ["101", "102m", "ivanov", "%", "a_b", "5-1", "", None, "long sentence has many words", "1", "h\\s", "zzz"]
    left = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, text string")
    right = spark.createDataFrame([(i, x) for i, x in enumerate(parts)], "pid int, part string")
    got = rows(contains_join(left, right, "id", "text", "part"), "id", "pid")
    import re

    def like(t, p):
        # only % and _ are special; the one backslash stands before an ordinary character and is dropped
        body = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in re.sub(r"\\([^%_\\])", r"\1", p.lower()))
        return re.fullmatch(".*" + body + ".*", t.lower(), re.S) is not None

    want = [(i, j) for i, t in enumerate(texts) for j, p in enumerate(parts) if t is not None and p is not None and like(t, p)]
    assert got == sorted(want, key=lambda r: tuple((True, str(v)) for v in r))
    assert "BroadcastNestedLoopJoin" not in plan(contains_join(left, right, "id", "text", "part"))


@pytest.mark.parametrize("tail", [" group {}", "-{}"])
def test_patterns_with_one_head_meet_few_texts(spark, tail):
    head = "Faculty of Physics and Mathematics"
    names = [head + tail.format(1000 + i) for i in range(300)]
    texts = [(i, f"{head} x {n} y") for i, n in enumerate(names * 3)]
    left = spark.createDataFrame(texts, "id int, text string")
    right = spark.createDataFrame([(n,) for n in names], "part string")
    folded = meetings(left.select("id", F.lower("text").alias("folded")), right.select(F.col("part").alias("pattern"), F.lower("part").alias("folded")))
    assert contains_join(left, right, "id", "text", "part").count() == 900
    assert folded.count() < 1200  # 270,000 pairs hold the head


def test_window_join_is_containment_of_ids(spark):
    left = spark.createDataFrame([("abcabcd",), ("bc",), ("",), (None,), ("xabc",)], "folder string")
    right = spark.createDataFrame([("abc",), ("bcd",), ("zz",), (None,)], "id string")
    assert rows(window_join(left, right, "folder", "id", 3), "folder", "id") == [("abcabcd", "abc"), ("abcabcd", "bcd"), ("xabc", "abc")]


def test_token_match_and_russian_stems(spark):
    df = spark.createDataFrame([("Лекция по механике и оптике", "механика"), ("Лекция", "и"), ("red ring", "ring red"), ("red", None)], "d string, q string")
    out = df.select(tokens_match(tokens("d"), tokens("q")).alias("m")).collect()
    assert [r.m for r in out] == [True, False, True, False]


def test_link_best(spark):
    events = spark.createDataFrame([(1, "group 101 math"), (2, "1012 physics"), (3, "nothing"), (4, None)], "event_id int, name string")
    groups = spark.createDataFrame([(7, "101"), (5, "1012"), (9, "1"), (8, "101")], "gid int, number string")
    assert rows(link_best(events, groups, "event_id", "name", "gid", "number")) == [(1, 7), (2, 5)]
    loose = link_best(events, groups, "event_id", "name", "gid", "number", contains=False, default_unmatched=True)
    assert rows(loose) == [(1, 7), (2, 5), (3, 5), (4, 5)]
    found = token_candidates(events, groups, "event_id", "name", "gid", "number")
    assert rows(found) == [(1, 7), (2, 5)]
    assert "BroadcastNestedLoopJoin" not in plan(found)


def test_member_join_keeps_spaces_and_repeats_once(spark):
    users = spark.createDataFrame([(1, "a@x, b@x"), (2, "c@x,c@x"), (3, None)], "uid int, mails string")
    members = spark.createDataFrame([("a@x",), ("b@x",), ("c@x",)], "mail string")
    assert rows(member_join(users, "mails", ",", members, "mail"), "uid", "mail") == [(1, "a@x"), (2, "c@x")]
    assert rows(member_join(users, "mails", ",", members, "mail", True), "uid", "mail") == [(1, "a@x"), (1, "b@x"), (2, "c@x")]
    assert "BroadcastNestedLoopJoin" not in plan(member_join(users, "mails", ",", members, "mail"))


@pytest.mark.parametrize(
    "name, first, last, agrees",
    [
        ("Ivan Petrov", "ivan", "Petrov ", True),
        ("Petrov  Ivan Olegovich", "Ivan", "Petrov", True),
        ("Ivan Olegovich Petrov", "Ivan", "Petrov", True),
        ("Petr Sidorov", "Ivan", "Petrov", False),
        ("Ivan", "Ivan", "Petrov", False),
        ("Ivan Petrov", " ", "Petrov", False),
    ],
)
def test_names_agree(spark, name, first, last, agrees):
    parts = name_parts(spark.createDataFrame([(1, name)], "id int, name string"), "id", "name")
    assert parts.select(names_agree(F.lit(first), F.lit(last)).alias("ok")).first().ok is agrees


MEMBER_COLUMNS = (
    "id, type_of_learning, rzd_status, academic_level, status, faculty, faculty_translated, email, date_of_birth, phone_number, image, "
    "rzd_datetime, rzd_number, status_gain_date, card_id, card_status, card_date, card_number, card_user, student_id, first_name, "
    "middle_name, last_name, first_name_translated, middle_name_translated, last_name_translated"
).split(", ")


def people(spark):
    names = ["Полное имя", "Номер студенческого билета", "Факультет", "Дата рождения", "Город"]
    param = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name string")
    source = spark.createDataFrame([(1, "user"), (2, "admin")], "id int, name string")
    info = spark.createDataFrame(
        [
            (10, 0, 1, "Ivan Petrov"), (10, 1, 1, "S1"), (10, 2, 1, "Physics"), (10, 2, 2, "Chem"), (10, 3, 1, "01.02.2000"), (10, 4, 1, " "),
            (11, 0, 1, "Other Name"), (11, 1, 1, "S1"), (12, 1, 1, " "), (12, 0, 1, "No Id"),
        ],
        "owner_id int, param_id int, source_id int, value string",
    )
    values = dict(
        id="1", student_id="S1", first_name="Ivan", last_name="Petrov", faculty="Physics", date_of_birth="2000-02-01", email="i@p",
        status="member", card_id="7", card_status="ok", card_date="d", card_number="n", card_user="u", faculty_translated="Physics En",
    )
    members = spark.createDataFrame([tuple(values.get(c) for c in MEMBER_COLUMNS)], ", ".join(f"{c} string" for c in MEMBER_COLUMNS))
    return info, param, source, members


def test_combine_and_satellites(spark):
    info, param, source, members = people(spark)
    table = combine(user_table(person_facts(info, param, source)), member_table(members))
    assert table.count() == 1
    row = table.first()
    assert (row.user_id, row.faculty, row.faculty_source) == (10, "Physics, Chem, Physics", "union_member, admin, user")
    assert (row.birthday, row.birthday_source) == ("01.02.2000", "union_member")
    assert row.full_name == "Ivan Petrov" and row.full_name_source == "union_member"
    assert row.status is None and row.card_id == "7" and row.faculty_eng == "Physics En, Chem, Physics"

    def empty(spec):
        cols = ", ".join(f"`{c}` string" for c in spec.values)
        return spark.createDataFrame([], f"{cols}, user_id int, source string, created timestamp, modified timestamp, is_deleted boolean")

    wanted = [s for s in SATELLITES if s.table in ("faculty", "city", "card", "student_id")]
    assert len(SATELLITES) == 28
    stored = {s.table: empty(s) for s in wanted}
    once = refresh_satellites(stored, info, param, source, members, "2024-01-01 00:00:00")
    assert rows(once["faculty"], "faculty", "user_id", "source") == [("Physics, Chem, Physics", 10, "union_member, admin, user")]
    assert once["city"].count() == 0 and once["card"].count() == 1 and once["student_id"].count() == 1


PAGE = """<html><body><table><tr><td>x</td></tr>
<tr><td>Group</td><td>101</td><td>h</td>
<tr><td class="tdtime">1</td><td class="tditem1">Math <b>A &amp; B</b></td></tr>
<tr><td class="tdtime">2</td><td class="tdsmall1">Odd</td></tr><tr><td class="tdsmall1">Even</td></tr>
<tr><td class="tdtime">3</td><td class="tdsmall1"><td class="tdsmall0">P</td><td class="tdsmall0">Q</td></td></tr>
<tr><td class="tdtime">4</td><td class="tditem1"> </td></tr>
<tr><td class="tdtime">5</td><td class="tditem1">never flushed</td></tr>
<tr><td class="delimiter"></td></tr>
<tr><td class="tdtime">1</td><td class="tditem1">day without delimiter</td></tr>
<td>end</td></table></body></html>"""


def test_html_lessons(spark):
    pages = spark.createDataFrame([("u", PAGE), ("short", "<html><body><tr></tr></body></html>")], "url string, raw_html string")
    got = rows(html_lessons(pages), "group", "weekday", "num", "start", "odd", "even", "name")
    assert got == [
        ("101", 0, 0, "9:00", True, True, "Math <b>A &amp; B</b>"),
        ("101", 0, 1, "10:50", False, True, "Even"),
        ("101", 0, 1, "10:50", True, False, "Odd"),
        ("101", 0, 2, "13:30", True, False, "P"),
        ("101", 0, 2, "13:30", True, False, "Q"),
    ]
    bad = spark.createDataFrame([("b", PAGE.replace("tditem1", "what")), ("u", PAGE)], "url string, raw_html string")
    with pytest.raises(Exception, match="cannot parse"):
        html_lessons(bad).collect()
    good, rejects = html_lessons(bad, "reject")
    assert good.count() == 5 and [r.url for r in rejects.collect()] == ["b"]


def test_calendar_against_daily_walk(spark):
    lessons = [(1, 0, True, False), (2, 3, False, True), (3, 6, True, True)]
    df = spark.createDataFrame(lessons, "id int, weekday int, odd boolean, even boolean")
    got = rows(calendar_expand(df, "2024-09-04", "2024-10-01", "2024-09-03"), "id", "date")
    start = datetime.date(2024, 9, 2)
    want = []
    for i, weekday, odd, even in lessons:
        day = datetime.date(2024, 9, 4)
        while day <= datetime.date(2024, 10, 1):
            week = (day - start).days // 7 + 1
            if day.weekday() == weekday and (odd if week % 2 else even):
                want.append((i, day))
            day += datetime.timedelta(1)
    assert got == want


def test_snapshot_diff(spark):
    schema = "id int, subject string, place array<int>, events_id array<int>"
    old = spark.createDataFrame([(1, "a", [1, 2], [9]), (2, "b", [1], [8]), (3, "c", None, [7])], schema)
    new = spark.createDataFrame([(11, "a", [2, 1, 2], []), (12, "d", [1], []), (13, "c", None, [])], schema)
    got = rows(snapshot_diff(old, new, ["subject"], ["place"], ["events_id"]), "action", "id", "events_id")
    assert got == [("create", 12, []), ("create", 13, []), ("delete", 2, [8]), ("delete", 3, [7]), ("remember", 11, [9])]
    unchanged = snapshot_diff(old, old, ["subject"], ["place"], ["events_id"]).filter("place is not null")
    assert {r.action for r in unchanged.collect()} == {"remember"}
    assert "BroadcastNestedLoopJoin" not in plan(unchanged)


def test_page_diff(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "url string, html string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], "url string, html string")
    assert rows(page_diff(new, old, "url", "html")) == [("b", "changed"), ("c", "removed"), ("d", "added")]

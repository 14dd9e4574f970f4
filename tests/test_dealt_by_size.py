"""Steps whose tasks follow the number of rows, so that none grows with the table."""

from helpers import plan, rows
from sedimart import session
from sedimart.operators.aggregates import eav_pivot
from sedimart.operators.merge import upsert
from sedimart.operators.people import SATELLITES, change_set, name_parts


def test_pivots_and_names_take_more_tasks_for_more_facts(spark, monkeypatch):
    facts = spark.createDataFrame([(i % 3, "a", f"x{i} y") for i in range(9)], "owner int, name string, value string")
    few = eav_pivot(facts, "owner", "name", "value", {"a": "first"})
    few_names = name_parts(facts, "owner", "value")
    assert "REPARTITION_BY_NUM" not in plan(few) + plan(few_names)
    monkeypatch.setattr(session, "ROWS_A_TASK", 1)
    many = eav_pivot(facts, "owner", "name", "value", {"a": "first"})
    many_names = name_parts(facts, "owner", "value")
    for df in (many, many_names):
        assert plan(df).count(", 9), REPARTITION_BY_NUM") == plan(df).count("Exchange hashpartitioning") == 2
    assert rows(many) == rows(few) and rows(many_names) == rows(few_names)
    assert rows(many)[0] == (0, "x0 y, x3 y, x6 y")


def test_offers_and_upserts_take_more_tasks_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_A_TASK", 1)
    table = lambda *data: spark.createDataFrame(data, "k int, v string")
    merged = upsert(table((1, "a"), (None, "n")), table((1, "b"), (2, "c")), ["k"], ["v"], rows=11)
    assert ", 11), REPARTITION_BY_NUM" in plan(merged) and plan(merged).count("Exchange hashpartitioning") == 1
    assert rows(merged) == [(None, "n"), (1, "b"), (2, "c")]
    spec = next(s for s in SATELLITES if s.table == "city")
    people = spark.createDataFrame([(1, "Rome", "user", "S1"), (1, "Rome", "user", "S1"), (2, None, "user", "S2")], "user_id long, city string, city_source string, student_id string")
    offered = change_set(people, [spec], "2024-01-01", 10)
    assert plan(offered).count("Exchange hashpartitioning") == 1 and ", 10), REPARTITION_BY_NUM" in plan(offered)
    assert [(r["user_id"], r["key"], r["values"]) for r in offered.collect()] == [(1, "Rome", {"city": "Rome"})]

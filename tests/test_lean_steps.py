"""Steps that must stay lean: no sums where tables are read, no shuffle kept after its stage."""

import time

from pyspark.sql import functions as F

from helpers import plan, rows
from sedimart.operators.aggregates import eav_pivot
from sedimart.operators.people import name_parts
from sedimart.plans.timetable import gathered_links
from sedimart.session import stage


def before_first_shuffle(df) -> str:
    return plan(df).rpartition("Exchange")[2]


def test_pivots_gather_nothing_where_facts_are_read(spark):
    facts = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "a", "w"), (1, "b", None), (2, None, "y"), (None, "a", "z")], "owner int, name string, value string")
    wide = eav_pivot(facts, "owner", "name", "value", {"a": "first", "b": "second"})
    assert "Aggregate" not in before_first_shuffle(wide)
    assert rows(wide) == [(None, "z", None), (1, "w, x", None), (2, None, None)]


def test_names_are_dealt_out_before_they_are_gathered(spark):
    named = name_parts(spark.createDataFrame([(1, "Ann  Lee"), (1, "Ann  Lee"), (1, "Lee Ann May"), (2, None)], "owner int, value string"), "owner", "value")
    assert "Aggregate" not in before_first_shuffle(named)
    assert rows(named) == [(1, ["Ann  Lee", "Lee Ann May"], ["ann", "lee"], ["ann", "lee"], ["lee"], ["may"]), (2, [], [], [], [], [])]


def test_links_are_shuffled_as_they_are(spark):
    ids = spark.createDataFrame([("e1", 5), ("e1", 5), ("e2", 6), (None, 7)], "event_id string, value long")
    more = spark.createDataFrame([("e1", 8), ("e3", None)], "event_id string, value long")
    names = spark.createDataFrame([("e1", "n")], "event_id string, value string")
    alike = gathered_links({"g": ids, "l": more})
    assert "Aggregate" not in before_first_shuffle(alike)
    assert rows(alike) == [("e1", 5, 8), ("e2", 6, None), ("e3", None, None)]
    assert rows(gathered_links({"g": ids, "l": names})) == [("e1", 5, "n"), ("e2", 6, None)]


def test_a_stage_leaves_no_shuffle(spark):
    shuffles = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = shuffles()
    kept = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")).repartition(3, "n"))
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert kept.count() == 7

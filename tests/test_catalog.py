"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from sedimart.catalog import ORACLES, QUERIES
from sedimart.sources.landing import TABLES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "log_level_cube", "scd2_apply", "eav_pivot", "contains_link", "snapshot_diff", "comment_mart", "payload_items", "user_info", "history_comment",
    "typed_strike", "dim_group", "lessons_created", "rental_factors", "table_size_snapshot",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    theirs = con.execute(ORACLES[name])
    names = [d[0] for d in theirs.description]
    assert sorted(df.columns) == sorted(names)
    mine = sorted(map(str, (tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())))
    assert mine == sorted(map(str, theirs.fetchall()))

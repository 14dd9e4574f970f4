"""Level cube, merges and table writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, cents, day, moment, query
from sedimart.functions.columns import shift_zone
from sedimart.operators.merge import insert_ignore, update_from, upsert
from sedimart.plans.infra import incident_history, log_cube, merge_log_cube
from sedimart.session import materialize, shared_folder
from sedimart.sources.tables import append_snapshot, full_refresh, replace_slice, retain, rotate_snapshot

FIRST_LOG, SECOND_LOG = "ts < timestamp '2024-01-20'", "ts >= timestamp '2024-01-10'"


def event_log(events: DataFrame) -> DataFrame:
    """Events as log rows: the value sets the level, clicks name it differently."""
    level = (
        F.when(F.col("value") < 10, "debug")
        .when(F.col("value") < 30, "INFO")
        .when(F.col("value") < 60, "Warning")
        .when(F.col("value") < 100, "ERROR")
        .when(F.col("value") < 200, "CRITICAL")
        .otherwise("trace")
    )
    message = F.concat(F.lit("event "), F.col("event_id").cast("string"))
    clicks = F.to_json(F.struct(level.alias("loglevel"), message.alias("message")))
    others = F.to_json(F.struct(level.alias("level_name"), message.alias("message")))
    return events.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "click", clicks).otherwise(others).alias("record"),
        F.concat(F.lit("svc_"), F.col("event_type")).alias("container_name"),
        F.col("ts").alias("create_ts"),
        "ts",
    )


LOG_SQL = """
WITH log AS (
  SELECT 'svc_' || event_type AS container_name, event_type, ts, strftime(ts, '%Y-%m-%d') AS create_date,
         'event ' || event_id AS message,
         CASE WHEN value < 10 THEN 'debug' WHEN value < 30 THEN 'INFO' WHEN value < 60 THEN 'Warning'
              WHEN value < 100 THEN 'ERROR' WHEN value < 200 THEN 'CRITICAL' ELSE 'trace' END AS lvl
  FROM events
)"""


def cube_sql(where: str) -> str:
    count = lambda c: f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT)"
    is_level = lambda v: count(f"upper(lvl) = '{v}'")
    return f"""
  SELECT CASE WHEN grouping(container_name) = 1 THEN 'all' ELSE container_name END AS container_name,
         CASE WHEN grouping(create_date) = 1 THEN 'all' ELSE create_date END AS create_date,
         {is_level('DEBUG')} AS debug_cnt, {is_level('WARNING')} AS warn_cnt, {is_level('INFO')} AS info_cnt,
         {is_level('ERROR')} AS error_cnt, {is_level('CRITICAL')} AS critical_cnt,
         {count("upper(lvl) NOT IN ('DEBUG', 'WARNING', 'INFO', 'ERROR', 'CRITICAL')")} AS other_cnt
  FROM log WHERE {where} GROUP BY CUBE (container_name, create_date)"""


@query("log_level_cube", LOG_SQL + cube_sql("true"))
def _(t: Tables) -> DataFrame:
    return log_cube(event_log(t.events), "svc_%")


COUNTS = ["debug_cnt", "warn_cnt", "info_cnt", "error_cnt", "critical_cnt", "other_cnt"]
_GREATEST = ", ".join(
    f"CASE WHEN f.container_name IS NULL OR f.container_name = 'all' OR f.create_date = 'all' THEN s.{c} "
    f"ELSE greatest(s.{c}, f.{c}) END AS {c}"
    for c in COUNTS
)


@query(
    "merge_conditional",
    LOG_SQL
    + f""", stored AS (SELECT * FROM ({cube_sql(FIRST_LOG)}) WHERE NOT (container_name = 'all' AND create_date = 'all')),
fresh AS ({cube_sql(SECOND_LOG)})
SELECT s.container_name, s.create_date, {_GREATEST}
FROM stored s LEFT JOIN fresh f ON s.container_name = f.container_name AND s.create_date = f.create_date
UNION ALL
SELECT f.container_name, f.create_date, {', '.join('f.' + c for c in COUNTS)}
FROM fresh f LEFT JOIN stored s ON s.container_name = f.container_name AND s.create_date = f.create_date
WHERE s.container_name IS NULL AND NOT (f.container_name = 'all' AND f.create_date = 'all')""",
)
def _(t: Tables) -> DataFrame:
    log = event_log(t.events)
    first = log_cube(log.filter(FIRST_LOG), "svc_%").filter("not (container_name = 'all' and create_date = 'all')")
    stored = materialize(first)  # stands for the stored table
    return merge_log_cube(stored, log_cube(log.filter(SECOND_LOG), "svc_%"))


@query(
    "merge_insert_only",
    LOG_SQL
    + f""", incident AS (
  SELECT message, container_name, ts FROM log WHERE event_type <> 'click' AND lvl IN ('ERROR', 'CRITICAL')
), stored AS (SELECT * FROM incident WHERE {FIRST_LOG})
SELECT message, container_name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS create_ts, 'old' AS load FROM stored
UNION ALL
SELECT i.message, i.container_name, strftime(i.ts, '%Y-%m-%d %H:%M:%S.%f'), 'new' FROM incident i
WHERE i.{SECOND_LOG} AND NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.message = i.message AND s.container_name = i.container_name AND s.ts = i.ts)""",
)
def _(t: Tables) -> DataFrame:
    log = event_log(t.events)
    empty = (
        "id string, msk_record_loaded_dttm timestamp_ntz, container_name string, message string, create_ts timestamp_ntz"
    )
    none = t.spark.createDataFrame([], empty)
    stored = materialize(incident_history(none, log.filter(FIRST_LOG), "2024-01-20 00:00:00"))
    merged = incident_history(stored, log.filter(SECOND_LOG), "2024-02-01 00:00:00")
    is_old = F.col("msk_record_loaded_dttm") == F.lit("2024-01-20").cast("timestamp_ntz")
    return merged.select(
        "message", "container_name", moment("create_ts").alias("create_ts"),
        F.when(is_old, "old").otherwise("new").alias("load"),
    )


@query(
    "upsert",
    """
WITH stored AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
), fresh AS (
  SELECT o_orderkey, 'X' AS o_orderstatus, round(o_totalprice + 100, 2) AS o_totalprice, 'NEW' AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
)
SELECT coalesce(s.o_orderkey, f.o_orderkey) AS o_orderkey, coalesce(f.o_orderstatus, s.o_orderstatus) AS o_orderstatus,
       coalesce(f.o_totalprice, s.o_totalprice) AS o_totalprice, coalesce(s.o_orderpriority, f.o_orderpriority) AS o_orderpriority
FROM stored s FULL JOIN fresh f ON s.o_orderkey = f.o_orderkey""",
)
def _(t: Tables) -> DataFrame:
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    stored = t.orders.filter("o_orderdate < timestamp_ntz '2000-01-01'").select(*cols)
    fresh = t.orders.filter("o_orderdate >= timestamp_ntz '1997-01-01'").select(
        "o_orderkey",
        F.lit("X").alias("o_orderstatus"),
        cents(F.col("o_totalprice") + 100).alias("o_totalprice"),
        F.lit("NEW").alias("o_orderpriority"),
    )
    return upsert(stored, fresh, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query(
    "insert_ignore",
    """
SELECT c_custkey AS custkey, 'debtor' AS kind FROM customer WHERE c_acctbal < 1000
UNION ALL
SELECT DISTINCT o_custkey, 'buyer' FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)""",
)
def _(t: Tables) -> DataFrame:
    stored = t.customer.filter("c_acctbal < 1000").select(F.col("c_custkey").alias("custkey"), F.lit("debtor").alias("kind"))
    fresh = t.orders.select(F.col("o_custkey").alias("custkey"), F.lit("buyer").alias("kind"))
    return insert_ignore(stored, fresh, ["custkey"])


@query(
    "update_from",
    """
SELECT p.p_partkey, p.p_size, CASE WHEN p.p_size > 10 AND l.top IS NOT NULL THEN l.top ELSE p.p_retailprice END AS price
FROM part p LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS top FROM lineitem GROUP BY l_partkey) l
  ON p.p_partkey = l.l_partkey""",
)
def _(t: Tables) -> DataFrame:
    top = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_extendedprice").alias("price"))
    parts = t.part.select("p_partkey", "p_size", F.col("p_retailprice").alias("price"))
    return update_from(parts, top, ["p_partkey"], {"price": lambda old, new: new}, where=F.col("p_size") > 10)


@query(
    "replace_slice",
    """
SELECT event_type AS source_name, event_id, user_id, value FROM events WHERE event_type <> 'view'
UNION ALL
SELECT 'view', event_id, user_id, round(value + 1, 2) FROM events WHERE event_type IN ('view', 'signup')""",
)
def _(t: Tables) -> DataFrame:
    target = t.events.select(F.col("event_type").alias("source_name"), "event_id", "user_id", "value")
    fresh = t.events.filter("event_type in ('view', 'signup')").select(
        "event_id", "user_id", cents(F.col("value") + 1).alias("value")
    )
    return replace_slice(target, fresh, "source_name", "view")


@query(
    "retain",
    """
SELECT event_id, event_type FROM events
WHERE event_type = 'error' OR NOT (ts < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 3 DAY)""",
)
def _(t: Tables) -> DataFrame:
    timed = t.events.withColumn("seen", F.when(F.col("event_type") != "error", F.col("ts")))
    return retain(timed, "seen", "2024-01-30 00:00:00", 3).select("event_id", "event_type")


@query(
    "tz_shift",
    """
SELECT event_id, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS moscow FROM events""",
)
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", moment(shift_zone("ts")).alias("moscow"))


@query("full_refresh", "SELECT o_orderkey, o_orderstatus, o_custkey + 1 AS o_custkey FROM orders")
def _(t: Tables) -> DataFrame:
    root = scratch(t, "full-refresh")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    full_refresh(rows, root)
    stored = full_refresh(rows, root)
    # the table is replaced by what is computed from it
    return full_refresh(stored.withColumn("o_custkey", F.col("o_custkey") + 1), root)


@query(
    "append_snapshot",
    """
SELECT s_suppkey, s_name, '2024-01-01' AS state_dt FROM supplier UNION ALL SELECT s_suppkey, s_name, '2024-01-02' FROM supplier""",
)
def _(t: Tables) -> DataFrame:
    path = scratch(t, "snapshots")
    rows = t.supplier.select("s_suppkey", "s_name")
    append_snapshot(rows, path, "2024-01-01")
    append_snapshot(rows, path, "2024-01-02")
    return append_snapshot(rows, path, "2024-01-02").withColumn("state_dt", day("state_dt"))


@query(
    "rotate_snapshot",
    """
SELECT 'current' AS side, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'previous', o_orderkey, o_totalprice FROM orders""",
)
def _(t: Tables) -> DataFrame:
    root = scratch(t, "rotation")
    rotate_snapshot(t.orders.select("o_orderkey", "o_totalprice"), root)
    settled = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice")
    current, previous = rotate_snapshot(settled, root)
    both = current.withColumn("side", F.lit("current")).unionByName(previous.withColumn("side", F.lit("previous")))
    return both.select("side", "o_orderkey", "o_totalprice")


def scratch(t: Tables, name: str) -> str:
    """A fresh folder for a query that writes, below the cluster's shared one."""
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"

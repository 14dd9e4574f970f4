"""SCD2 histories of the customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, cents, day, query
from sedimart.operators.history import scd2_apply, scd2_close, scd2_current, scd2_increment

CMP = ["name", "nation", "balance", "segment"]
DS = "2024-02-01"


def versions(t: Tables) -> DataFrame:
    """Every customer with an open version and a closed, older one."""
    base = t.customer.select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    date = lambda d: F.lit(d).cast("date")
    live = base.withColumns({"valid_from_dt": date("2024-01-01"), "valid_to_dt": F.lit(None).cast("date")})
    older = base.withColumn("balance", cents(F.col("balance") - 100)).withColumns(
        {"valid_from_dt": date("2023-01-01"), "valid_to_dt": date("2024-01-01")}
    )
    return live.unionByName(older)


def next_day(t: Tables) -> DataFrame:
    """Next state: balances of BUILDING changed, segments of MACHINERY unknown, FURNITURE gone,
    AUTOMOBILE back at the older balance, suppliers new."""
    segment = F.col("c_mktsegment")
    kept = t.customer.filter(segment != "FURNITURE").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.when(segment == "BUILDING", cents(F.col("c_acctbal") + 10))
        .when(segment == "AUTOMOBILE", cents(F.col("c_acctbal") - 100))
        .otherwise(F.col("c_acctbal"))
        .alias("balance"),
        F.when(segment != "MACHINERY", segment).alias("segment"),
    )
    new = t.supplier.select(
        (F.col("s_suppkey") + 1_000_000_000).alias("key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
        F.lit("SUPPLIER").alias("segment"),
    )
    return kept.unionByName(new)


def shown(hist: DataFrame) -> DataFrame:
    return hist.withColumns({c: day(c) for c in ("valid_from_dt", "valid_to_dt")})


HIST_SQL = """
WITH hist AS (
  SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment,
         '2024-01-01' AS valid_from_dt, CAST(NULL AS VARCHAR) AS valid_to_dt FROM customer
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, round(c_acctbal - 100, 2), c_mktsegment, '2023-01-01', '2024-01-01' FROM customer
), snap AS (
  SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation,
         CASE c_mktsegment WHEN 'BUILDING' THEN round(c_acctbal + 10, 2)
              WHEN 'AUTOMOBILE' THEN round(c_acctbal - 100, 2) ELSE c_acctbal END AS balance,
         CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment
  FROM customer WHERE c_mktsegment <> 'FURNITURE'
  UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
), closed AS (
  SELECT h.key, h.name, h.nation, h.balance, h.segment, h.valid_from_dt,
         CASE WHEN h.valid_to_dt IS NULL AND NOT EXISTS (
           SELECT 1 FROM snap s WHERE s.key = h.key AND s.name IS NOT DISTINCT FROM h.name
             AND s.nation IS NOT DISTINCT FROM h.nation AND s.balance IS NOT DISTINCT FROM h.balance
             AND s.segment IS NOT DISTINCT FROM h.segment) THEN '2024-02-01' ELSE h.valid_to_dt END AS valid_to_dt
  FROM hist h
), applied AS (
  SELECT * FROM closed
  UNION ALL
  SELECT s.*, '2024-02-01', NULL FROM snap s
  WHERE NOT EXISTS (SELECT 1 FROM closed c WHERE c.key = s.key AND c.valid_to_dt IS NULL)
)
"""


@query("scd2_close", HIST_SQL + "SELECT * FROM closed")
def _(t: Tables) -> DataFrame:
    return shown(scd2_close(versions(t), next_day(t), "key", CMP, DS))


@query(
    "scd2_increment",
    HIST_SQL
    + """SELECT * FROM hist UNION ALL SELECT s.*, '2024-02-01', NULL FROM snap s
WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.key = s.key AND h.valid_to_dt IS NULL)""",
)
def _(t: Tables) -> DataFrame:
    return shown(scd2_increment(versions(t), next_day(t), "key", DS))


@query("scd2_apply", HIST_SQL + "SELECT * FROM applied")
def _(t: Tables) -> DataFrame:
    return shown(scd2_apply(versions(t), next_day(t), "key", CMP, DS))


@query("scd2_current", HIST_SQL + "SELECT * FROM applied WHERE valid_to_dt IS NULL")
def _(t: Tables) -> DataFrame:
    return shown(scd2_current(scd2_apply(versions(t), next_day(t), "key", CMP, DS)))


@query(
    "scd2_apply_as_written",
    HIST_SQL
    + """, stamped AS (
  SELECT h.key, h.name, h.nation, h.balance, h.segment, h.valid_from_dt,
         CASE WHEN h.key NOT IN (
           SELECT d.key FROM hist d JOIN snap s ON d.key = s.key AND d.name = s.name AND d.nation = s.nation
             AND d.balance = s.balance AND d.segment IS NOT DISTINCT FROM s.segment)
         THEN '2024-02-01' ELSE h.valid_to_dt END AS valid_to_dt
  FROM hist h
)
SELECT * FROM stamped
UNION ALL
SELECT s.key, s.name, s.nation, s.balance, s.segment, '2024-02-01', NULL
FROM snap s FULL OUTER JOIN stamped h ON s.key = h.key
WHERE h.key IS NULL OR h.valid_to_dt = '2024-02-01'""",
)
def _(t: Tables) -> DataFrame:
    return shown(scd2_apply(versions(t), next_day(t), "key", CMP, DS, compat=True, null_safe=["segment"]))


@query(
    "scd2_apply_open_matches",
    HIST_SQL
    + """, stamped AS (
  SELECT h.key, h.name, h.nation, h.balance, h.segment, h.valid_from_dt,
         CASE WHEN h.key NOT IN (
           SELECT d.key FROM hist d JOIN snap s ON d.key = s.key AND d.name = s.name AND d.nation = s.nation
             AND d.balance = s.balance AND d.segment = s.segment WHERE d.valid_to_dt IS NULL)
         THEN '2024-02-01' ELSE h.valid_to_dt END AS valid_to_dt
  FROM hist h
)
SELECT * FROM stamped
UNION ALL
SELECT s.key, s.name, s.nation, s.balance, s.segment, '2024-02-01', NULL
FROM snap s FULL OUTER JOIN stamped h ON s.key = h.key
WHERE h.key IS NULL OR h.valid_to_dt = '2024-02-01'""",
)
def _(t: Tables) -> DataFrame:
    return shown(scd2_apply(versions(t), next_day(t), "key", CMP, DS, compat=True, open_only=True))

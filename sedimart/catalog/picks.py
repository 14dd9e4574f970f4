"""Window picks, global ranks, batches, and small aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, day, moment, query
from sedimart.operators.aggregates import dim_dedupe, merge_to_arrays, newest_cohort
from sedimart.operators.ranking import (
    batch,
    best_per_group,
    completeness_dedupe,
    global_rank,
    keep_first,
    latest_attribute,
    latest_per_key,
    top_k,
)
from sedimart.plans.rating import ods_lecturer, rank_lecturers


@query(
    "latest_per_key",
    """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    newest = latest_per_key(t.events, ["user_id"], "ts", [F.col("event_id")])
    return newest.select("user_id", "event_id", "event_type", moment("ts").alias("ts"))


@query(
    "best_per_group",
    """
SELECT l_orderkey, l_extendedprice, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_extendedprice", "l_partkey", "l_suppkey")
    order = [F.col("l_extendedprice").desc(), F.col("l_partkey"), F.col("l_suppkey")]
    return best_per_group(rows, ["l_orderkey"], order)


@query(
    "completeness_dedupe",
    """
WITH c AS (
  SELECT c_custkey, c_nationkey, c_name, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment,
         CASE WHEN c_acctbal > 0 THEN 'paid' ELSE ' ' END AS note FROM customer
), s AS (
  SELECT *, CAST((CASE WHEN trim(c_name) <> '' THEN 1 ELSE 0 END) + (CASE WHEN trim(coalesce(segment, '')) <> '' THEN 1 ELSE 0 END)
         + (CASE WHEN trim(note) <> '' THEN 1 ELSE 0 END) AS INTEGER) AS completeness_score FROM c
)
SELECT c_nationkey, c_custkey, completeness_score FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY completeness_score DESC, c_custkey) AS rn FROM s)
WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    rows = t.customer.select(
        "c_custkey",
        "c_nationkey",
        "c_name",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, "paid").otherwise(" ").alias("note"),
    )
    best = completeness_dedupe(rows, "c_nationkey", ["c_name", "segment", "note"], [F.col("c_custkey")])
    return best.select("c_nationkey", "c_custkey", "completeness_score")


@query(
    "global_rank",
    """
SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END DESC NULLS FIRST, o_orderkey) AS rank
FROM orders""",
)
def _(t: Tables) -> DataFrame:
    score = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return global_rank(t.orders.select("o_orderkey", score.alias("score")), "score", ["o_orderkey"]).drop("score")


@query(
    "lecturer_rank",
    """
WITH hist AS (
  SELECT p_partkey AS api_id, p_retailprice AS mark, '2024-01-01' AS valid_from_dt, CAST(NULL AS VARCHAR) AS valid_to_dt FROM part
  UNION ALL SELECT p_partkey, p_retailprice + 1, '2023-01-01', '2024-01-01' FROM part
)
SELECT h.api_id, h.valid_from_dt, CASE WHEN h.valid_to_dt IS NULL THEN r.rank ELSE 0 END AS rank
FROM hist h JOIN (SELECT api_id, row_number() OVER (ORDER BY mark DESC, api_id) AS rank FROM hist WHERE valid_to_dt IS NULL) r
  ON h.api_id = r.api_id""",
)
def _(t: Tables) -> DataFrame:
    date = lambda d: F.lit(d).cast("date")
    base = t.part.select(
        F.col("p_partkey").alias("api_id"), F.col("p_retailprice").alias("mark_weighted"), F.lit(0).cast("bigint").alias("rank")
    )
    live = base.withColumns({"valid_from_dt": date("2024-01-01"), "valid_to_dt": F.lit(None).cast("date")})
    old = base.withColumn("mark_weighted", F.col("mark_weighted") + 1).withColumns(
        {"valid_from_dt": date("2023-01-01"), "valid_to_dt": date("2024-01-01")}
    )
    ranked = rank_lecturers(live.unionByName(old))
    return ranked.select("api_id", day("valid_from_dt").alias("valid_from_dt"), "rank")


@query(
    "latest_attribute",
    """
SELECT user_id, attribute, value, strftime(modified, '%Y-%m-%d') AS modified FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, attribute ORDER BY modified DESC, created DESC, value) AS rn
  FROM (SELECT user_id, event_type AS attribute, value, date_trunc('day', ts) AS modified, ts AS created FROM events
        WHERE NOT (value > 200))) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    attrs = t.events.select(
        "user_id",
        F.col("event_type").alias("attribute"),
        "value",
        F.date_trunc("day", "ts").alias("modified"),
        F.col("ts").alias("created"),
        (F.col("value") > 200).alias("is_deleted"),
    )
    return latest_attribute(attrs, "user_id", "attribute").select("user_id", "attribute", "value", day("modified").alias("modified"))


@query(
    "weighted_rating",
    """
WITH c AS (
  SELECT l_partkey AS k, CAST(round(l_quantity) AS INTEGER) - 25 AS kind, CAST(round(l_discount * 100) AS INTEGER) - 5 AS free,
         CAST(round(l_tax * 100) AS INTEGER) - 4 AS clear FROM lineitem
), m AS (SELECT k, kind, free, clear, (kind + free + clear) // 3 AS total FROM c),
g AS (SELECT avg(total) AS t, avg(kind) AS ki, avg(clear) AS cl, avg(free) AS fr FROM m),
p AS (SELECT k, count(*) AS n, avg(total) AS t, avg(kind) AS ki, avg(clear) AS cl, avg(free) AS fr FROM m GROUP BY k)
SELECT p.k AS api_id, part.p_name AS last_name,
       round((p.t * n + g.t * 0.75) / (n + 0.75), 6) AS mark_weighted,
       round((p.ki * n + g.ki * 0.75) / (n + 0.75), 6) AS mark_kindness_weighted,
       round((p.cl * n + g.cl * 0.75) / (n + 0.75), 6) AS mark_clarity_weighted,
       round((p.fr * n + g.fr * 0.75) / (n + 0.75), 6) AS mark_freebie_weighted
FROM p CROSS JOIN g JOIN part ON part.p_partkey = p.k""",
)
def _(t: Tables) -> DataFrame:
    lecturers = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("first_name"),
        F.col("p_name").alias("last_name"),
        F.col("p_type").alias("middle_name"),
        F.lit(None).cast("string").alias("subject"),
        F.lit(None).cast("string").alias("avatar_link"),
        F.col("p_size").alias("timetable_id"),
    )
    whole = lambda c, less: (F.round(c).cast("int") - less)
    comments = t.lineitem.select(
        F.col("l_orderkey").alias("uuid"),
        F.col("l_partkey").alias("lecturer_id"),
        whole(F.col("l_quantity"), 25).alias("mark_kindness"),
        whole(F.col("l_discount") * 100, 5).alias("mark_freebie"),
        whole(F.col("l_tax") * 100, 4).alias("mark_clarity"),
    )
    marks = ["mark_weighted", "mark_kindness_weighted", "mark_clarity_weighted", "mark_freebie_weighted"]
    return ods_lecturer(lecturers, comments).select("api_id", "last_name", *[F.round(m, 6).alias(m) for m in marks])


@query(
    "keep_first",
    """
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    first = keep_first(t.orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "merge_to_arrays",
    """
WITH a AS (
  SELECT l_orderkey, l_returnflag, l_linestatus, array_to_string(list_sort(list(DISTINCT l_suppkey)), '|') AS suppliers
  FROM lineitem GROUP BY ALL
)
SELECT l_orderkey, suppliers, string_agg(l_returnflag || l_linestatus, '|' ORDER BY l_returnflag || l_linestatus) AS flags
FROM a GROUP BY l_orderkey, suppliers""",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("flags"), F.col("l_suppkey").alias("suppliers"))
    by_flag = merge_to_arrays(rows, ["l_orderkey", "flags"], ["suppliers"])
    by_set = merge_to_arrays(by_flag, ["l_orderkey", "suppliers"], ["flags"])
    return by_set.select("l_orderkey", *[F.array_join(F.col(c).cast("array<string>"), "|").alias(c) for c in ("suppliers", "flags")])


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    "cohort_max",
    """
SELECT event_id, user_id FROM events
WHERE value <= 300 AND date_trunc('day', ts) = (SELECT max(date_trunc('day', ts)) FROM events)""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id", "user_id", F.date_trunc("day", "ts").alias("modified"), (F.col("value") > 300).alias("is_deleted")
    )
    return newest_cohort(rows).select("event_id", "user_id")


@query(
    "any_value_agg",
    """
SELECT l_orderkey, max(CASE WHEN l_returnflag = 'R' THEN l_returnflag END) AS flag,
       count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned FROM lineitem GROUP BY l_orderkey""",
)
def _(t: Tables) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "R", F.col("l_returnflag"))
    return t.lineitem.groupBy("l_orderkey").agg(F.any_value(flag, True).alias("flag"), F.count(flag).alias("returned"))


@query(
    "basic_aggregates",
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END)::BIGINT AS taxed,
       round(sum(l_extendedprice), 2) AS price, round(avg(l_quantity), 6) AS quantity, min(l_discount) AS low, max(l_discount) AS high
FROM lineitem GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("l_tax") > 0.04, 1).otherwise(0)).alias("taxed"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.avg("l_quantity"), 6).alias("quantity"),
        F.min("l_discount").alias("low"),
        F.max("l_discount").alias("high"),
    )


@query(
    "dim_dedupe",
    """
SELECT p_name AS name, p_brand AS brand, min(p_partkey) AS part_id, min(p_type) AS kind FROM part
WHERE p_type <> 'PROMO' GROUP BY p_name, p_brand""",
)
def _(t: Tables) -> DataFrame:
    parts = t.part.withColumn("is_deleted", F.col("p_type") == "PROMO")
    natural = {"name": F.col("p_name"), "brand": F.col("p_brand")}
    return dim_dedupe(parts, natural, "p_partkey", "part_id", {"p_type": "kind"})


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t: Tables) -> DataFrame:
    return top_k(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 100)


@query("capped", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey").orderBy("o_orderkey")


@query(
    "batches",
    """
SELECT o_orderkey, rn AS row_no, (rn - 1) // 100 AS batch_no
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return batch(rows, [F.col("o_orderdate"), F.col("o_orderkey")], 100).drop("o_orderdate")

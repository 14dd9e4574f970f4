"""Attribute pivots, enriched profiles and person resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, query
from sedimart.functions.columns import survive, survive_source
from sedimart.operators.aggregates import eav_pivot
from sedimart.operators.people import SATELLITES, name_parts, resolve_ids, resolve_person, satellite_upsert
from sedimart.plans.userdata import auth_user

KINDS = ["click", "error", "purchase", "signup", "view"]
_PROP = "json_extract_string(props, '$.k')"
_PICK = lambda k, v: f"string_agg(DISTINCT CASE WHEN event_type = '{k}' THEN {v} END, ', ' ORDER BY CASE WHEN event_type = '{k}' THEN {v} END)"


def facts(t: Tables) -> DataFrame:
    return t.events.select(
        "user_id", "event_type", F.get_json_object("props", "$.k").alias("k"), F.date_format("ts", "EEEE").alias("weekday")
    )


@query("eav_pivot", "SELECT user_id, " + ", ".join(f"{_PICK(k, _PROP)} AS {k}" for k in KINDS) + " FROM events GROUP BY user_id")
def _(t: Tables) -> DataFrame:
    return eav_pivot(facts(t), "user_id", "event_type", "k", {k: k for k in KINDS})


@query(
    "eav_pivot_sources",
    "SELECT user_id, "
    + ", ".join(f"{_PICK(k, _PROP)} AS {k}, {_PICK(k, 'dayname(ts)')} AS {k}_source" for k in KINDS)
    + " FROM events GROUP BY user_id",
)
def _(t: Tables) -> DataFrame:
    return eav_pivot(facts(t), "user_id", "event_type", "k", {k: k for k in KINDS}, "weekday")


@query(
    "eav_enriched",
    f"""
WITH info AS (SELECT user_id, {', '.join(f"{_PICK(k, _PROP)} AS {k}" for k in ('click', 'view'))} FROM events GROUP BY user_id),
auth AS (SELECT user_id, {_PICK('signup', _PROP)} AS auth_email FROM events GROUP BY user_id)
SELECT info.user_id AS id, click, "view", auth_email, c_acctbal < 0 AS is_deleted
FROM info LEFT JOIN auth USING (user_id) LEFT JOIN customer ON c_custkey = info.user_id""",
)
def _(t: Tables) -> DataFrame:
    info = eav_pivot(facts(t), "user_id", "event_type", "k", {"click": "click", "view": "view"})
    param = F.when(F.col("event_type") == "signup", "email").otherwise(F.col("event_type"))
    methods = facts(t).select("user_id", param.alias("param"), F.col("k").alias("value"))
    accounts = t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") < 0).alias("is_deleted"))
    return auth_user(info, methods, accounts)


# A customer and a supplier are built into people: both have a student id, and the supplier's
# name is spelled First Last, Last First Middle or First Middle Last after its nation.
_PEOPLE_SQL = """
WITH words AS (
  SELECT c_custkey AS user_id, 'S' || (c_custkey % 100000) AS student_id, 'First' || c_nationkey AS f, 'Last' || (c_custkey % 100000) AS l,
         'Mid' || length(c_mktsegment) AS m, c_mktsegment AS faculty, c_nationkey AS nation
  FROM customer
), users AS (
  SELECT *, CASE nation % 4 WHEN 0 THEN f || ' ' || l WHEN 1 THEN l || '  ' || f || ' ' || m WHEN 2 THEN f || ' ' || m || ' ' || l ELSE m || ' ' || m END AS name
  FROM words
), members AS (
  SELECT s_suppkey AS id, 'S' || s_suppkey AS student_id, 'first' || n AS first_name, ' LAST' || s_suppkey AS last_name,
         CASE WHEN s_acctbal > 5000 THEN 'BUILDING' END AS faculty
  FROM (SELECT s_suppkey, s_acctbal, c_nationkey AS n FROM supplier JOIN customer ON c_custkey = s_suppkey)
)"""


def people(t: Tables) -> tuple[DataFrame, DataFrame]:
    nation = F.col("c_nationkey")
    number = F.pmod("c_custkey", F.lit(100_000)).cast("string")
    first, last = F.concat(F.lit("First"), nation.cast("string")), F.concat(F.lit("Last"), number)
    middle = F.concat(F.lit("Mid"), F.length("c_mktsegment").cast("string"))
    space = F.lit(" ")
    order = F.pmod(nation, F.lit(4))
    name = (
        F.when(order == 0, F.concat(first, space, last))
        .when(order == 1, F.concat(last, F.lit("  "), first, space, middle))
        .when(order == 2, F.concat(first, space, middle, space, last))
        .otherwise(F.concat(middle, space, middle))
    )
    users = t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("S"), number).alias("student_id"),
        name.alias("name"),
        F.col("c_mktsegment").alias("faculty"),
    )
    nations = t.customer.select(F.col("c_custkey").alias("s_suppkey"), nation.cast("string").alias("n"))
    members = t.supplier.join(nations, "s_suppkey").select(
        F.col("s_suppkey").alias("id"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("student_id"),
        F.concat(F.lit("first"), F.col("n")).alias("first_name"),
        F.concat(F.lit(" LAST"), F.col("s_suppkey").cast("string")).alias("last_name"),
        F.lit(None).cast("string").alias("first_name_translated"),
        F.lit(None).cast("string").alias("last_name_translated"),
        F.when(F.col("s_acctbal") > 5000, "BUILDING").alias("faculty"),
    )
    return users, members


def matched(t: Tables) -> DataFrame:
    users, members = people(t)
    named = users.join(name_parts(users, "user_id", "name"), "user_id")
    return resolve_person(named, members)


@query(
    "name_parts",
    _PEOPLE_SQL
    + """, w AS (SELECT user_id, name, string_split(trim(regexp_replace(lower(name), '\\s+', ' ', 'g')), ' ') AS w FROM users)
SELECT user_id, w[1] AS w1, w[2] AS w2, CASE WHEN len(w) = 3 THEN w[1] ELSE '' END AS t1, CASE WHEN len(w) = 3 THEN w[3] ELSE '' END AS t3 FROM w""",
)
def _(t: Tables) -> DataFrame:
    users, _members = people(t)
    parts = name_parts(users, "user_id", "name")
    return parts.select("user_id", *[F.array_join(c, "|").alias(c) for c in ("w1", "w2", "t1", "t3")])


_MATCH_SQL = _PEOPLE_SQL + """, hit AS (
  SELECT u.user_id, u.student_id, u.name, u.faculty, m.id AS member_id, m.faculty AS um_faculty
  FROM users u JOIN members m ON u.student_id = m.student_id
  WHERE u.nation % 4 <> 3 AND lower(trim(m.first_name)) = lower(u.f) AND lower(trim(m.last_name)) = lower(u.l)
)"""


@query("person_resolution", _MATCH_SQL + "SELECT user_id, student_id, member_id FROM hit")
def _(t: Tables) -> DataFrame:
    return matched(t).select("user_id", "student_id", F.col("um_id").alias("member_id"))


@query(
    "survivorship",
    _MATCH_SQL
    + """
SELECT user_id, CASE WHEN um_faculty IS NOT NULL AND um_faculty <> faculty THEN um_faculty || ', ' || faculty
            WHEN um_faculty IS NOT NULL THEN um_faculty ELSE faculty END AS faculty,
       CASE WHEN um_faculty IS NOT NULL AND um_faculty <> faculty THEN 'member, user'
            WHEN um_faculty IS NOT NULL THEN 'member' ELSE 'user' END AS faculty_source
FROM hit""",
)
def _(t: Tables) -> DataFrame:
    sources = (F.lit("member"), F.lit("user"))
    return matched(t).select(
        "user_id",
        survive("um_faculty", "faculty").alias("faculty"),
        survive_source("um_faculty", "faculty", *sources).alias("faculty_source"),
    )


@query(
    "satellite_upsert",
    """
WITH stored AS (
  SELECT CASE WHEN c_acctbal > 0 THEN c_mktsegment ELSE 'OLD' END AS faculty, CAST(c_custkey AS INTEGER) AS user_id, 'stored' AS source,
         '2024-01-01' AS created, '2024-01-01' AS modified FROM customer
), fresh AS (
  SELECT c_mktsegment AS faculty, CAST(c_custkey AS INTEGER) AS user_id, 'fresh' AS source FROM customer
  WHERE c_nationkey < 20 AND c_mktsegment <> 'MACHINERY'
)
SELECT coalesce(s.faculty, f.faculty) AS faculty, coalesce(s.user_id, f.user_id) AS user_id, coalesce(f.source, s.source) AS source,
       coalesce(s.created, '2024-02-01') AS created, CASE WHEN f.source IS NULL THEN s.modified ELSE '2024-02-01' END AS modified,
       s.user_id IS NOT NULL AND s.faculty = 'OLD' AS is_deleted
FROM stored s FULL JOIN fresh f ON s.user_id = f.user_id AND s.faculty = f.faculty""",
)
def _(t: Tables) -> DataFrame:
    faculty = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise("OLD")
    old = F.lit("2024-01-01").cast("timestamp")
    stored = t.customer.select(
        faculty.alias("faculty"), F.col("c_custkey").cast("int").alias("user_id"), F.lit("stored").alias("source"),
        old.alias("created"), old.alias("modified"), (faculty == "OLD").alias("is_deleted"),
    )
    combined = t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).otherwise(" ").alias("faculty"),
        F.lit("fresh").alias("faculty_source"),
        F.when(F.col("c_nationkey") < 20, F.col("c_name")).alias("student_id"),
    )
    spec = next(s for s in SATELLITES if s.table == "faculty")
    done = satellite_upsert(stored, combined, spec, "2024-02-01 00:00:00")
    return done.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("created", "modified")})


@query(
    "resolve_ids",
    """
WITH named AS (
  SELECT l_orderkey, list(CASE WHEN p_type = 'PROMO' THEN -100 ELSE d.id END ORDER BY l_partkey, l_suppkey, l_linenumber) AS ids
  FROM lineitem JOIN part ON p_partkey = l_partkey
  LEFT JOIN (SELECT p_name, min(p_partkey) AS id FROM part GROUP BY p_name) d ON d.p_name = part.p_name
  GROUP BY l_orderkey
)
SELECT l_orderkey, array_to_string(ids, '|') AS parts FROM named""",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    name = F.when(F.col("p_type") == "PROMO", F.lit("no such part")).otherwise(F.col("p_name")).alias("p_name")
    place = F.struct("l_partkey", "l_suppkey", "l_linenumber", name)
    arrays = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(place)), lambda x: x["p_name"]).alias("parts"))
    done, _create = resolve_ids(arrays, "l_orderkey", "parts", t.part, "p_name", "p_partkey", -100)
    return done.select("l_orderkey", F.array_join(F.col("parts").cast("array<string>"), "|").alias("parts"))

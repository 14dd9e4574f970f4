"""Payload tables for other systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, query
from sedimart.operators.outbound import (
    lecturer_payload,
    membership_changes,
    pending_digest,
    printer_list,
    profile_items,
    profile_payload,
)


@query(
    "payload_rows",
    """
SELECT CAST(c_custkey AS INTEGER) AS id, c_acctbal AS mark_weighted,
       '{"id":' || c_custkey || ',"first_name":"x","last_name":"' || c_name || '","middle_name":"y","avatar_link":' ||
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'null' ELSE '"' || c_mktsegment || '"' END || ',"timetable_id":' || c_nationkey ||
       ',"mark_weighted":1.5,"mark_kindness_weighted":1.5,"mark_clarity_weighted":1.5,"mark_freebie_weighted":1.5,"rank":1}' AS payload
FROM customer WHERE c_acctbal > 0""",
)
def _(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    hist = t.customer.select(
        F.col("c_custkey").alias("api_id"), F.lit("x").alias("first_name"), F.col("c_name").alias("last_name"),
        F.lit("y").alias("middle_name"), F.when(segment != "BUILDING", segment).alias("avatar_link"),
        F.col("c_nationkey").alias("timetable_id"),
        *[F.lit(1.5).alias(m) for m in ("mark_weighted", "mark_kindness_weighted", "mark_clarity_weighted", "mark_freebie_weighted")],
        F.lit(1).alias("rank"),
        F.when(F.col("c_acctbal") <= 0, F.lit("2024-01-01")).cast("date").alias("valid_to_dt"),
    )
    balances = t.customer.select(F.col("c_custkey").cast("int").alias("id"), F.col("c_acctbal").alias("mark_weighted"))
    return lecturer_payload(hist).select("id", "payload").join(balances, "id")


_ITEMS_SQL = """
WITH attrs AS (
  SELECT user_id, CASE event_type WHEN 'click' THEN 'phone_number' WHEN 'view' THEN 'full_name' WHEN 'signup' THEN 'education_level' ELSE 'photo' END AS attribute,
         CASE WHEN event_type = 'signup' THEN 'level ' || CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 ELSE event_id || ',' || event_type END AS value,
         ts FROM events WHERE value <= 200
), newest AS (
  SELECT user_id, attribute, CASE WHEN attribute = 'full_name' THEN split_part(value, ',', -1) ELSE split_part(value, ',', 1) END AS value
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, attribute ORDER BY ts DESC, value) AS rn FROM attrs) WHERE rn = 1
), users AS (SELECT DISTINCT c_custkey AS user_id FROM customer WHERE c_acctbal > 0),
wide AS (
  SELECT user_id, coalesce(max(CASE WHEN attribute = 'phone_number' THEN value END), '') AS phone_number,
         coalesce(max(CASE WHEN attribute = 'full_name' THEN value END), '') AS full_name,
         coalesce(max(CASE WHEN attribute = 'education_level' THEN value END), '') AS education_level,
         coalesce(max(CASE WHEN attribute = 'photo' THEN value END), '') AS photo
  FROM users LEFT JOIN newest USING (user_id) GROUP BY user_id
)
"""


def _items(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    attribute = F.when(kind == "click", "phone_number").when(kind == "view", "full_name").when(kind == "signup", "education_level")
    value = F.when(kind == "signup", F.concat(F.lit("level "), F.pmod(k, F.lit(3)).cast("string"))).otherwise(
        F.concat_ws(",", F.col("event_id").cast("string"), kind)
    )
    attrs = t.events.select(
        "user_id", attribute.otherwise("photo").alias("attribute"), value.alias("value"),
        F.col("ts").alias("created"), F.col("ts").alias("modified"), (F.col("value") > 200).alias("is_deleted"),
    )
    cohort = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    mapping = t.spark.createDataFrame([("level 0", "Zero"), ("level 1", "One")], "code string, label string")
    return profile_items(attrs, cohort, mapping)


@query(
    "payload_items",
    _ITEMS_SQL
    + """
SELECT user_id, i.position, i.param, i.value FROM (
  SELECT user_id, unnest([
    {'position': 1, 'param': 'Членство в профсоюзе', 'value': 'true'}, {'position': 2, 'param': 'Номер телефона', 'value': phone_number},
    {'position': 3, 'param': 'Номер профсоюзного билета', 'value': ''}, {'position': 4, 'param': 'Полное имя', 'value': full_name},
    {'position': 5, 'param': 'Full name', 'value': ''}, {'position': 6, 'param': 'Дата рождения', 'value': ''},
    {'position': 7, 'param': 'Факультет', 'value': ''}, {'position': 8, 'param': 'Faculty', 'value': ''},
    {'position': 9, 'param': 'Ступень обучения', 'value': education_level},
    {'position': 10, 'param': 'Ступень обучения', 'value': CASE education_level WHEN 'level 0' THEN 'Zero' WHEN 'level 1' THEN 'One' END},
    {'position': 11, 'param': 'Фото', 'value': photo}]) AS i FROM wide)""",
)
def _(t: Tables) -> DataFrame:
    return _items(t).select("user_id", "position", "param", "value")


@query(
    "payload_documents",
    _ITEMS_SQL + "SELECT user_id, 11 AS items, phone_number AS phone, 'dwh' AS source FROM wide",
)
def _(t: Tables) -> DataFrame:
    text = profile_payload(_items(t))
    return text.select(
        "user_id",
        F.json_array_length(F.get_json_object("payload", "$.items")).alias("items"),
        F.get_json_object("payload", "$.items[1].value").alias("phone"),
        F.get_json_object("payload", "$.source").alias("source"),
    )


@query(
    "membership_reconcile",
    """
WITH members AS (SELECT c_custkey AS user_id FROM customer WHERE c_mktsegment = 'BUILDING'),
groups AS (SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 5000 THEN [22, c_nationkey + 100] ELSE [c_nationkey + 100] END AS g FROM customer),
inside AS (SELECT user_id FROM groups WHERE list_contains(g, 22))
SELECT user_id, 'add' AS action, array_to_string(CASE WHEN list_contains(g, 22) THEN g ELSE list_append(g, 22) END, '|') AS groups FROM members JOIN groups USING (user_id)
UNION ALL
SELECT user_id, 'remove', array_to_string(list_filter(g, lambda x: x <> 22), '|') FROM inside JOIN groups USING (user_id)
WHERE user_id NOT IN (SELECT user_id FROM members)""",
)
def _(t: Tables) -> DataFrame:
    own = F.col("c_nationkey") + 100
    groups = t.customer.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") > 5000, F.array(F.lit(22), own)).otherwise(F.array(own)).alias("groups"),
    )
    members = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    inside = groups.filter(F.array_contains("groups", 22)).select("user_id")
    out = membership_changes(members, groups, inside, 22)
    return out.select("user_id", "action", F.array_join(F.col("groups").cast("array<string>"), "|").alias("groups"))


@query(
    "printer_list",
    """
SELECT username, union_number, CAST(NULL AS VARCHAR) AS student_number FROM (
  SELECT c_name AS username, CASE WHEN c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS union_number,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS rn
  FROM customer WHERE c_mktsegment LIKE '%IN%' AND c_acctbal > 0 AND length(c_name) > 0) WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    card = F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("string")).otherwise("")
    members = t.customer.select(
        F.col("c_name").alias("last_name"), card.alias("card_number"), F.col("c_mktsegment").alias("faculty"), F.lit("Active").alias("status")
    )
    return printer_list(members, "in", "active")


_COMMENTS_SQL = """
WITH comments AS (
  SELECT conv_id || '/' || turn AS uuid, conv_id AS lecturer_id, role AS subject, text, CASE WHEN role = 'user' THEN conv_id END AS user_id,
         TIMESTAMP '2024-01-01' + to_hours(CAST(turn AS INTEGER)) AS update_ts FROM conversations
)
"""


def _comments(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    comments = t.conversations.select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("uuid"),
        F.col("conv_id").alias("lecturer_id"),
        F.col("role").alias("subject"),
        "text",
        F.when(F.col("role") == "user", F.col("conv_id")).alias("user_id"),
        (start + F.make_dt_interval(hours=F.col("turn").cast("int"))).alias("update_ts"),
    )
    lecturers = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("last_name"), F.lit("Ann").alias("first_name"), F.lit("Bea").alias("middle_name")
    )
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("full_name"))
    return comments, lecturers, users


@query(
    "pending_digest",
    _COMMENTS_SQL
    + """
SELECT uuid, s_name || 'A.B.' AS lecturer, subject, CASE WHEN user_id IS NULL THEN 'Anonim' ELSE c_name END AS author,
       CASE WHEN length(text) < 17 THEN text ELSE substring(text, 1, 13) || '...' END AS short_text
FROM comments LEFT JOIN supplier ON s_suppkey = lecturer_id LEFT JOIN customer ON c_custkey = user_id
WHERE update_ts >= TIMESTAMP '2024-01-01 02:00:00'""",
)
def _(t: Tables) -> DataFrame:
    return pending_digest(*_comments(t), "2024-01-01 02:00:00", "2024-01-02")[0]


@query(
    "pending_totals",
    _COMMENTS_SQL
    + """
SELECT 'tuesday' AS day, CAST(sum(CASE WHEN update_ts >= TIMESTAMP '2024-01-01 02:00:00' THEN 1 ELSE 0 END) AS BIGINT) AS total_today, count(*) AS total_unreviewed FROM comments
UNION ALL SELECT 'monday', 0, count(*) FROM comments""",
)
def _(t: Tables) -> DataFrame:
    tuesday = pending_digest(*_comments(t), "2024-01-01 02:00:00", "2024-01-02")[1]
    monday = pending_digest(*_comments(t), "2024-01-01 02:00:00", "2024-01-01")[1]
    return tuesday.withColumn("day", F.lit("tuesday")).unionByName(monday.withColumn("day", F.lit("monday")))

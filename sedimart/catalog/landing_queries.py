"""Landing: mirrors, nested documents, keys and encryption, schema drift, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.merges import scratch
from sedimart.catalog.registry import Tables, day, moment, query
from sedimart.operators.quality import schema_drift, table_sizes
from sedimart.plans.rental import ods_table
from sedimart.plans.timetable import flattened_lessons
from sedimart.sources.crypto import decrypt, generate_keys, mirror_encrypted
from sedimart.sources.landing import (
    LESSON_SCHEMA,
    TABLES,
    array_field_join,
    flatten_json,
    lessons_ingest,
    load_backup,
    members_ingest,
    mirror_table,
    paging_column,
    stack_children,
)
from sedimart.sources.tables import full_refresh


@query(
    "mirror_table",
    """
SELECT event_id, ts_text, event_type, '{"user_id":' || user_id || ',"tags":["' || event_type || '"]}' AS details
FROM (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text FROM events)""",
)
def _(t: Tables) -> DataFrame:
    source = t.events.select(
        "event_id", moment("ts").alias("ts_text"), "event_type", "value",
        F.struct("user_id", F.array("event_type").alias("tags")).alias("details"),
    )
    target = ["event_id", "ts_text", "event_type", "details", "column_without_source"]
    return mirror_table(source, target, paging_column(source.columns))


@query(
    "flatten_json",
    """
SELECT event_id, event_type AS kind_name, user_id AS kind_by_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS kind_by_props_k FROM events""",
)
def _(t: Tables) -> DataFrame:
    props = F.from_json("props", "k int").alias("props")
    by = F.struct(F.col("user_id").alias("id"), props).alias("by")
    nested = t.events.select("event_id", F.struct(F.col("event_type").alias("name"), by).alias("kind"))
    return flatten_json(nested)


@query(
    "array_join_field",
    """
SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY l_partkey, l_suppkey, l_linenumber) AS items FROM lineitem GROUP BY l_orderkey""",
)
def _(t: Tables) -> DataFrame:
    item = F.struct("l_partkey", "l_suppkey", "l_linenumber", F.col("l_partkey").cast("string").alias("code"))
    lists = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return array_field_join(lists, "items", "code")


@query(
    "stack_children",
    """
SELECT 'click' AS parent, event_id, value AS amount, props AS extra FROM events WHERE event_type = 'click'
UNION ALL SELECT 'view', event_id, value, NULL FROM events WHERE event_type = 'view'
UNION ALL SELECT 'other', event_id, NULL, props FROM events WHERE event_type NOT IN ('click', 'view')""",
)
def _(t: Tables) -> DataFrame:
    part = lambda where, *cols: t.events.filter(where).select("event_id", *cols)
    amount, extra = F.col("value").alias("amount_+1"), F.col("props").alias("extra")
    frames = [
        part("event_type = 'click'", amount, extra),
        part("event_type = 'view'", amount),
        part("event_type not in ('click', 'view')", extra),
    ]
    return stack_children(frames, "parent", ["click", "view", "other"], {"amount_+1": "amount"})


@query(
    "members_ingest",
    """
SELECT c_custkey AS id, c_name AS last_name, CASE WHEN c_acctbal > 0 THEN c_custkey + 5 END AS card_id,
       CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS card_status, CASE WHEN c_nationkey < 20 THEN 'S' || c_custkey END AS student_id,
       CASE WHEN c_nationkey < 20 THEN 'Faculty ' || c_nationkey END AS faculty_translated, CAST(NULL AS VARCHAR) AS rzd_number
FROM customer""",
)
def _(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    card = F.when(F.col("c_acctbal") > 0, F.struct((key + 5).alias("id"), F.col("c_mktsegment").alias("status")))
    listed = t.customer.select(F.to_json(F.struct(key.alias("id"), F.col("c_name").alias("last_name"), card.alias("card"))).alias("j"))
    detail = t.customer.filter("c_nationkey < 20").select(
        F.to_json(
            F.struct(
                key.alias("id"),
                F.concat(F.lit("S"), key.cast("string")).alias("student_id"),
                F.concat(F.lit("Faculty "), F.col("c_nationkey").cast("string")).alias("faculty_title_eng"),
                F.lit("not wanted").alias("extra"),
            )
        ).alias("j")
    )
    members = listed.select(F.from_json("j", "id bigint, last_name string, card struct<id: bigint, status: string>").alias("m"))
    details = detail.select(F.from_json("j", "id bigint, student_id string, faculty_title_eng string, extra string").alias("m"))
    out = members_ingest(members.select("m.*"), details.select("m.*"))
    return out.select("id", "last_name", "card_id", "card_status", "student_id", "faculty_translated", "rzd_number")


def lesson_documents(t: Tables) -> DataFrame:
    """Lesson documents, one per order: urgent ones lack a room, low ones have no group, some no valid time."""
    named = lambda key, name: F.struct(F.col(key).alias("id"), name.alias("name"))
    priority = F.col("o_orderpriority")
    low = priority == "5-LOW"
    group = named("o_custkey", F.concat(F.lit("g"), F.col("o_custkey").cast("string")))
    teacher = F.struct(
        F.col("o_orderkey").alias("id"), F.lit("Sur").alias("sur_name"),
        F.when(priority != "2-HIGH", "First").alias("first_name"), F.lit("Second").alias("second_name"),
    )
    document = F.struct(
        F.when(low, F.array().cast("array<struct<id: bigint, name: string>>"))
        .otherwise(F.array(group, named("o_orderkey", F.lit("second group"))))
        .alias("study_groups"),
        named("o_orderkey", priority).alias("discipline"),
        F.when(priority != "1-URGENT", named("o_custkey", F.lit("room"))).alias("classroom"),
        F.struct(F.lit("lecture").alias("name")).alias("lesson_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(F.col("o_orderstatus") == "F", "morning").otherwise("09:00").alias("time_from"),
        F.lit("10:35").alias("time_to"),
        F.array(teacher).alias("teacher_users"),
    )
    text = t.orders.select("o_orderkey", F.to_json(document).alias("j"))
    return text.select("o_orderkey", F.from_json("j", LESSON_SCHEMA).alias("d")).select("o_orderkey", "d.*")


@query(
    "lessons_ingest",
    """
SELECT 'g' || o_custkey AS group_name, o_orderpriority AS dicscipline_name, o_orderkey AS discipline_id, o_custkey AS classroom_id,
       strftime(o_orderdate, '%Y-%m-%d') || ' 09:00:00.000000' AS lesson_from, strftime(o_orderdate, '%Y-%m-%d') || ' 10:35:00.000000' AS lesson_to,
       '[{"id":' || o_custkey || ',"name":"g' || o_custkey || '"},{"id":' || o_orderkey || ',"name":"second group"}]' AS study_groups
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_orderstatus <> 'F'""",
)
def _(t: Tables) -> DataFrame:
    rows, _rejects = lessons_ingest(lesson_documents(t))
    return rows.select(
        "group_name", "dicscipline_name", "discipline_id", "classroom_id",
        moment("lesson_from_dttm_ts").alias("lesson_from"), moment("lesson_to_dttm_ts").alias("lesson_to"), "study_groups",
    )


@query(
    "lessons_rejects",
    """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'no study group' WHEN o_orderpriority = '1-URGENT' THEN 'no classroom' ELSE 'no start' END AS reject_reason,
       count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') OR o_orderstatus = 'F' GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    _rows, rejects = lessons_ingest(lesson_documents(t))
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "two_array_flatten",
    """
WITH lessons AS (SELECT * FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_orderstatus <> 'F')
SELECT o_orderkey AS discipline_id, CASE WHEN o_orderpriority <> '2-HIGH' THEN 'Sur First Second' END AS teacher_full_name,
       CAST(o_custkey AS INTEGER) AS study_group_id, '"g' || o_custkey || '"' AS study_group_name FROM lessons
UNION ALL
SELECT o_orderkey, CASE WHEN o_orderpriority <> '2-HIGH' THEN 'Sur First Second' END, CAST(o_orderkey AS INTEGER), '"second group"' FROM lessons""",
)
def _(t: Tables) -> DataFrame:
    rows, _rejects = lessons_ingest(lesson_documents(t))
    return flattened_lessons(rows).select("discipline_id", "teacher_full_name", "study_group_id", "study_group_name")


@query("load_backup", "SELECT s_suppkey AS id, s_name || ', it''s' AS name, s_acctbal AS mark FROM supplier")
def _(t: Tables) -> DataFrame:
    folder = scratch(t, "backup")
    dump = t.supplier.select("s_suppkey", F.concat("s_name", F.lit(", it's")).alias("name"), "s_acctbal")
    dump.write.option("quote", "'").option("escape", "'").csv(folder)
    return load_backup(t.spark, folder, "id bigint, name string, mark double")


def _keys(t: Tables) -> DataFrame:
    """Stored keys of the customers: derived here, so that the result can be compared."""
    digest = F.unhex(F.md5(F.col("c_custkey").cast("string").cast("binary")))
    return t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.base64(digest).alias("key"))


@query(
    "encrypt_round_trip",
    """
SELECT o_orderkey AS id, o_custkey AS owner_id, o_orderpriority AS value FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0""",
)
def _(t: Tables) -> DataFrame:
    source = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("owner_id"), F.col("o_orderpriority").alias("value"))
    sealed = mirror_encrypted(source, _keys(t), ["value"], "owner_id")
    return decrypt(sealed, _keys(t), ["value"], "owner_id")


@query("generate_keys", "SELECT c_custkey AS id, c_acctbal > 0 AS is_old, 24 AS key_length FROM customer")
def _(t: Tables) -> DataFrame:
    users = t.customer.select(F.col("c_custkey").alias("id"))
    # random keys are written once and read back
    keys = full_refresh(generate_keys(users, _keys(t)), scratch(t, "keys"))
    old = _keys(t).select("id", F.col("key").alias("old_key"))
    both = keys.join(old, "id", "left")
    is_old = F.coalesce(F.col("key") == F.col("old_key"), F.lit(False))
    return both.select("id", is_old.alias("is_old"), F.length("key").alias("key_length"))


# Column lists derived from the lines: a supplier is a table, a part's price group a column.
@query(
    "schema_drift",
    """
WITH src AS (
  SELECT DISTINCT 'DWH_' || l_returnflag AS s, 't' || l_suppkey AS t, 'c' || (l_partkey % 100) AS c FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'
), tgt AS (
  SELECT DISTINCT 'DWH_' || l_returnflag AS s, 't' || l_suppkey AS t, 'c' || (l_partkey % 100) AS c FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'
), drift AS (
  SELECT 'missing in target' AS drift, * FROM (SELECT * FROM src EXCEPT SELECT * FROM tgt)
  UNION ALL SELECT 'extra in target', * FROM (SELECT * FROM tgt EXCEPT SELECT * FROM src)
)
SELECT drift, s AS table_schema, t AS table_name, string_agg(c, ', ' ORDER BY c) AS columns FROM drift GROUP BY drift, s, t""",
)
def _(t: Tables) -> DataFrame:
    def columns(where: str, prefix: str) -> DataFrame:
        text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
        return t.lineitem.filter(where).select(
            text(prefix, F.col("l_returnflag")).alias("table_schema"),
            text("t", F.col("l_suppkey")).alias("table_name"),
            text("c", F.pmod("l_partkey", F.lit(100))).alias("column_name"),
        )

    source = columns("l_shipdate < timestamp_ntz '1999-01-01'", "api_")
    target = columns("l_shipdate >= timestamp_ntz '1998-01-01'", "DWH_")
    return schema_drift(source, target, {f"api_{f}": f"DWH_{f}" for f in "ANR"})


@query(
    "table_size_snapshot",
    " UNION ALL ".join(f"SELECT 20240101 AS id, '{name}' AS table_name, 'given' AS table_schema, count(*) AS n_rows, true AS has_size, '2024-01-01' AS state_dt FROM {name}" for name in TABLES),
)
def _(t: Tables) -> DataFrame:
    sizes = table_sizes({("given", name): getattr(t, name) for name in TABLES}, "2024-01-01")
    has_size = (F.col("total_bytes") > 0) & (F.col("total_size_mb") == F.floor(F.col("total_bytes") / (1024 * 1024)))
    return sizes.select("id", "table_name", "table_schema", "n_rows", has_size.alias("has_size"), day("state_dt").alias("state_dt"))


@query(
    "typed_refresh",
    """
SELECT o_orderkey AS api_id, o_custkey AS user_id, o_orderstatus AS status, strftime(o_orderdate + INTERVAL 4 HOUR, '%H') IN ('03', '04') AS moved,
       strftime(timezone('Europe/Moscow', timezone('UTC', o_orderdate)), '%Y-%m-%d %H:%M:%S.%f') AS start_ts
FROM orders""",
)
def _(t: Tables) -> DataFrame:
    none = F.lit(None).cast("int")
    raw = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), none.alias("item_id"), none.alias("admin_open_id"),
        none.alias("admin_close_id"), F.col("o_orderstatus").alias("status"),
        *[F.col("o_orderdate").alias(c) for c in ("reservation_ts", "start_ts", "end_ts", "actual_return_ts")],
    )
    out = ods_table("rental_session", raw)
    hours = F.hour("end_ts") - F.hour(F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    return out.select("api_id", "user_id", "status", hours.isin(3, 4).alias("moved"), moment("start_ts").alias("start_ts"))

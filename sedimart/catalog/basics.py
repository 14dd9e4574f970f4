"""Set operations, predicates and the scalar function families."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, moment, query
from sedimart.functions.columns import (
    concat_nulls_empty,
    differs_from_any,
    first_item,
    flag_contains,
    guarded_int,
    in_array,
    keep_if,
    last_item,
    like_built,
    not_in_array,
    path_tail,
    same,
    shift_zone,
)


@query(
    "union_branches",
    """
SELECT event_id, 'k=' || json_extract_string(props, '$.k') AS text FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'other ' || event_type FROM events WHERE event_type <> 'click'""",
)
def _(t: Tables) -> DataFrame:
    clicks = t.events.filter("event_type = 'click'").select(
        "event_id", F.concat(F.lit("k="), F.get_json_object("props", "$.k")).alias("text")
    )
    others = t.events.filter("event_type <> 'click'").select("event_id", F.concat(F.lit("other "), "event_type").alias("text"))
    return clicks.unionByName(others)


@query(
    "union_missing_columns",
    """
SELECT c_custkey AS id, c_mktsegment AS segment, NULL AS kind FROM customer UNION ALL SELECT p_partkey, NULL, p_type FROM part""",
)
def _(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    parts = t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("kind"))
    return customers.unionByName(parts, allowMissingColumns=True)


@query(
    "set_difference",
    """
WITH a AS (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem WHERE l_quantity <= 25),
b AS (SELECT DISTINCT l_partkey, l_returnflag FROM lineitem WHERE l_quantity > 25)
SELECT 'only a' AS side, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'only b', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
UNION ALL SELECT 'both', * FROM (SELECT * FROM a INTERSECT SELECT * FROM b)""",
)
def _(t: Tables) -> DataFrame:
    pick = lambda where: t.lineitem.filter(where).select("l_partkey", "l_returnflag")
    a = pick("l_quantity <= 25").withColumns({"a": F.lit(1), "b": F.lit(0)})
    b = pick("l_quantity > 25").withColumns({"a": F.lit(0), "b": F.lit(1)})
    # both differences and the intersection out of one aggregation
    sides = a.unionByName(b).groupBy("l_partkey", "l_returnflag").agg(F.max("a").alias("a"), F.max("b").alias("b"))
    side = F.when(F.col("b") == 0, "only a").when(F.col("a") == 0, "only b").otherwise("both")
    return sides.select(side.alias("side"), "l_partkey", "l_returnflag")


@query("id_difference", "SELECT DISTINCT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def _(t: Tables) -> DataFrame:
    ids = t.customer.select(F.col("c_custkey").alias("id")).distinct()
    return ids.join(t.events.select(F.col("user_id").alias("id")), "id", "left_anti")


_NULLED = "(SELECT *, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment FROM customer)"


def _nulled(t: Tables) -> DataFrame:
    return t.customer.withColumn("segment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))


@query(
    "predicates",
    f"""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'rich' END AS class, coalesce(segment, 'none') AS segment,
       coalesce(segment IN ('MACHINERY', 'FURNITURE'), false) AS listed, coalesce(segment <> ALL (SELECT unnest(['MACHINERY', 'FURNITURE'])), false) AS unlisted,
       length(segment) > 8 AS long_name, true AS live
FROM {_NULLED} WHERE NOT (c_acctbal > 9000)""",
)
def _(t: Tables) -> DataFrame:
    balance, segment = F.col("c_acctbal"), F.col("segment")
    pair = ["MACHINERY", "FURNITURE"]
    live = _nulled(t).withColumn("is_deleted", balance > 9000).filter(~F.col("is_deleted"))
    return live.select(
        "c_custkey",
        F.when(balance < 0, "debt").when(balance < 5000, "some").otherwise("rich").alias("class"),
        F.coalesce(segment, F.lit("none")).alias("segment"),
        F.coalesce(in_array(segment, pair), F.lit(False)).alias("listed"),
        F.coalesce(not_in_array(segment, pair), F.lit(False)).alias("unlisted"),
        (F.length(segment) > 8).alias("long_name"),
        (~F.col("is_deleted")).alias("live"),
    )


@query(
    "null_safe_compare",
    f"""
SELECT a.c_custkey, a.segment IS NOT DISTINCT FROM b.other AS same, a.segment IS DISTINCT FROM NULL AS known
FROM {_NULLED} a JOIN (SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS other FROM customer) b USING (c_custkey)""",
)
def _(t: Tables) -> DataFrame:
    other = F.when(F.col("c_nationkey") < 12, F.col("c_mktsegment"))
    return _nulled(t).select("c_custkey", same("segment", other).alias("same"), F.col("segment").isNotNull().alias("known"))


@query(
    "conditional_keep",
    f"""
SELECT c_custkey, CASE WHEN segment IS NOT NULL AND balance IS NOT NULL THEN segment END AS segment,
       CASE WHEN segment IS NOT NULL AND balance IS NOT NULL THEN balance END AS balance
FROM (SELECT *, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM {_NULLED})""",
)
def _(t: Tables) -> DataFrame:
    rows = _nulled(t).withColumn("balance", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    return rows.select("c_custkey", keep_if("segment", "balance").alias("segment"), keep_if("balance", "segment").alias("balance"))


@query(
    "pattern_filter",
    """
SELECT doc_id, coalesce(text ILIKE '%THE%', false) AS has_the, regexp_matches(text, '^[A-Z][a-z]+ ') AS starts_plain,
       NOT regexp_matches(text, '[0-9]') AS no_digit, text LIKE '%' || lang || '%' AS names_lang, lang LIKE '_n' AS ends_n
FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        flag_contains("text", "THE").alias("has_the"),
        F.col("text").rlike("^[A-Z][a-z]+ ").alias("starts_plain"),
        (~F.col("text").rlike("[0-9]")).alias("no_digit"),
        like_built("text", "lang", ignore_case=False).alias("names_lang"),
        F.col("lang").like("_n").alias("ends_n"),
    )


@query(
    "string_functions",
    """
SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, trim('  ' || p_type || ' ') AS trimmed, p_name || NULL AS nothing,
       concat_ws('-', p_name, NULL, p_type) AS skipped, concat(p_name, NULL, p_type) AS emptied, substring(p_name, 1, 4) AS cut,
       split_part(p_name, ' ', 1) AS first_part, split_part(p_name, ' ', -1) AS last_part, replace(p_brand, '#', '') AS replaced,
       strpos(p_name, 'ring') AS found, length(p_name) AS len
FROM part""",
)
def _(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    return t.part.select(
        "p_partkey",
        F.upper("p_name").alias("up"),
        F.lower("p_brand").alias("low"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("trimmed"),
        F.concat("p_name", none).alias("nothing"),
        F.concat_ws("-", F.col("p_name"), none, F.col("p_type")).alias("skipped"),
        concat_nulls_empty("p_name", none, "p_type").alias("emptied"),
        F.left("p_name", F.lit(4)).alias("cut"),
        first_item("p_name", " ").alias("first_part"),
        last_item("p_name", " ").alias("last_part"),
        F.replace("p_brand", F.lit("#"), F.lit("")).alias("replaced"),
        F.locate("ring", F.col("p_name")).cast("bigint").alias("found"),
        F.length("p_name").cast("bigint").alias("len"),
    )


@query(
    "regex_functions",
    r"""
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '', 'g') AS consonants, regexp_replace(p_brand, '^(\w+)#(\d+)$', '\2') AS number,
       regexp_replace('a  b ' || p_name, '\s+', ' ', 'g') AS collapsed, CASE WHEN regexp_matches(split_part(p_brand, '#', 2), '^[0-9]+$')
       THEN CAST(split_part(p_brand, '#', 2) AS INTEGER) ELSE 0 END AS guarded, 0 AS refused
FROM part""",
)
def _(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.regexp_replace("p_name", "[aeiou]", "").alias("consonants"),
        F.regexp_replace("p_brand", r"^(\w+)#(\d+)$", "$2").alias("number"),
        F.regexp_replace(F.concat(F.lit("a  b "), "p_name"), r"\s+", " ").alias("collapsed"),
        guarded_int(path_tail("p_brand", "#"), 0).alias("guarded"),
        guarded_int("p_name", 0).alias("refused"),
    )


@query(
    "datetime_functions",
    """
SELECT event_id, strftime(timezone('Europe/Moscow', timezone('UTC', ts)), '%Y-%m-%d %H:%M:%S.%f') AS moscow, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
       strftime(ts - INTERVAL 3 DAY, '%Y-%m-%d %H:%M:%S.%f') AS before, ts < TIMESTAMP '2024-01-15' AS early, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS number
FROM events""",
)
def _(t: Tables) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.events.select(
        "event_id",
        moment(shift_zone("ts")).alias("moscow"),
        F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd").alias("day"),
        moment(text.cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(3))).alias("before"),
        (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).alias("early"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("number"),
    )


@query(
    "array_functions",
    """
WITH a AS (SELECT l_orderkey, list(l_suppkey ORDER BY l_suppkey) AS s, max(l_suppkey) AS top FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CAST(len(s) AS INTEGER) AS n, s[1] AS first, array_to_string(s, ',') AS text, list_contains(s, 5) AS has_five,
       array_to_string(list_append(s, -1), ',') AS longer, len(list_filter(s, lambda x: x <> top)) > 0 AS differs, list_has_all(s, [top]) AS covers
FROM a""",
)
def _(t: Tables) -> DataFrame:
    lists = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_suppkey")).alias("s"), F.max("l_suppkey").alias("top"))
    text = lambda c: F.array_join(c.cast("array<string>"), ",")
    s = F.col("s")
    return lists.select(
        "l_orderkey",
        F.size(s).alias("n"),
        F.element_at(s, 1).alias("first"),
        text(s).alias("text"),
        F.array_contains(s, 5).alias("has_five"),
        text(F.array_append(s, F.lit(-1).cast("bigint"))).alias("longer"),
        differs_from_any("s", "top").alias("differs"),
        (F.size(F.array_except(F.array("top"), s)) == 0).alias("covers"),
    )


@query(
    "json_functions",
    """
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS next,
       json_extract_string(props, '$.missing') AS missing, CASE WHEN event_id % 2 = 0 THEN 'OBJECT' ELSE 'ARRAY<' END AS kind, '{"id":' || event_id || '}' AS packed
FROM events""",
)
def _(t: Tables) -> DataFrame:
    doc = F.parse_json("props")
    return t.events.select(
        "event_id",
        F.variant_get(doc, "$.k", "string").alias("k"),
        (F.variant_get(doc, "$.k", "int") + 1).alias("next"),
        F.variant_get(doc, "$.missing", "string").alias("missing"),
        F.substring(F.schema_of_variant(F.parse_json(F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise("[1]"))), 1, 6).alias("kind"),
        F.to_json(F.struct(F.col("event_id").alias("id"))).alias("packed"),
    )


@query(
    "math_functions",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, greatest(l_linenumber, l_suppkey) AS big, (l_partkey - 500) // 3 AS whole,
       round(l_extendedprice + l_quantity, 2) AS unit, CAST(floor(l_extendedprice / 100) AS BIGINT) AS hundreds, abs(l_linenumber - 4) AS off
FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.greatest(F.col("l_linenumber").cast("bigint"), "l_suppkey").alias("big"),
        F.expr("(l_partkey - 500) div 3").alias("whole"),
        F.round(F.col("l_extendedprice") + F.col("l_quantity"), 2).alias("unit"),
        F.floor(F.col("l_extendedprice") / 100).alias("hundreds"),
        F.abs(F.col("l_linenumber") - 4).alias("off"),
    )


@query("ordered_rows", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey ORDER BY r_name DESC, n_name")
def _(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_nationkey", "n_name", "r_name").orderBy(F.col("r_name").desc(), "n_name")

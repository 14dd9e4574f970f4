"""Joins and the marts that are mostly joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, day, moment, query
from sedimart.functions.columns import array_key
from sedimart.operators.joins import array_set_join, latest_version_join, path_key_join
from sedimart.plans.marketing import frontend_actions_services
from sedimart.plans.rating import comment_mart
from sedimart.plans.rental import rentals_mart
from sedimart.plans.timetable import timetable_mart
from sedimart.plans.userdata import member_matches, refresh_member_join


@query("join_inner", "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t: Tables) -> DataFrame:
    rich = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "join_left_agg",
    """
SELECT c_custkey, n, top FROM customer
LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY o_custkey)
USING (c_custkey)""",
)
def _(t: Tables) -> DataFrame:
    sums = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    )
    return t.customer.select("c_custkey").join(sums, ["c_custkey"], "left")


@query(
    "join_full_outer",
    """
SELECT coalesce(a.k, b.k) AS k, a.n AS old_n, b.n AS new_n
FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1) a
FULL OUTER JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1) b ON a.k = b.k""",
)
def _(t: Tables) -> DataFrame:
    side = lambda where, out: t.orders.filter(where).groupBy(F.col("o_custkey").alias(f"{out}_k")).agg(F.count(F.lit(1)).alias(out))
    old = side("o_orderdate < timestamp_ntz '1998-01-01'", "old_n")
    new = side("o_orderdate >= timestamp_ntz '1998-01-01'", "new_n")
    joined = old.join(new, F.col("old_n_k") == F.col("new_n_k"), "full_outer")
    return joined.select(F.coalesce("old_n_k", "new_n_k").alias("k"), "old_n", "new_n")


@query(
    "join_lateral",
    "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
)
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def _(t: Tables) -> DataFrame:
    large = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(large, "c_custkey", "left_semi")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def _(t: Tables) -> DataFrame:
    large = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(large, "c_custkey", "left_anti")


@query(
    "scalar_subquery",
    """
SELECT o_orderkey, o_orderdate = (SELECT max(o_orderdate) FROM orders) AS is_last,
       CAST(o_orderkey AS DOUBLE) / (SELECT count(*) FROM orders) AS share FROM orders""",
)
def _(t: Tables) -> DataFrame:
    total = t.orders.agg(F.struct(F.max("o_orderdate").alias("last"), F.count(F.lit(1)).alias("n")).alias("s")).scalar()
    return t.orders.select(
        "o_orderkey",
        (F.col("o_orderdate") == total.getField("last")).alias("is_last"),
        (F.col("o_orderkey") / total.getField("n")).alias("share"),
    )


@query(
    "join_residual_exists",
    """
SELECT o_orderkey, o_custkey FROM orders JOIN (
  SELECT l_orderkey, list(l_suppkey % 10) AS suppliers FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
WHERE list_contains(suppliers, o_custkey % 10)""",
)
def _(t: Tables) -> DataFrame:
    digit = lambda c: F.pmod(F.col(c), F.lit(10))
    lists = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(digit("l_suppkey")).alias("suppliers"))
    # equality first, the test on the list stays as the join's extra condition
    on = (F.col("o_orderkey") == F.col("l_orderkey")) & F.exists("suppliers", lambda x: x == digit("o_custkey"))
    return t.orders.join(lists, on).select("o_orderkey", "o_custkey")


@query(
    "join_change_detect",
    """
SELECT a.o_orderkey FROM orders a JOIN (
  SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders) b
ON a.o_orderkey = b.o_orderkey AND a.o_custkey = b.o_custkey AND a.o_orderstatus = b.o_orderstatus AND a.o_totalprice = b.o_totalprice""",
)
def _(t: Tables) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    price = F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return t.orders.select(*cols).join(t.orders.withColumn("o_totalprice", price).select(*cols), cols).select("o_orderkey")


@query(
    "array_set_join",
    """
WITH a AS (SELECT l_orderkey, list_sort(list(DISTINCT l_suppkey)) AS s FROM lineitem GROUP BY l_orderkey),
f AS (SELECT s, min(l_orderkey) AS first_order FROM a GROUP BY s)
SELECT l_orderkey, first_order FROM a JOIN f ON a.s = f.s""",
)
def _(t: Tables) -> DataFrame:
    lists = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("s"))
    firsts = lists.groupBy(array_key("s").alias("k")).agg(F.min("l_orderkey").alias("first_order"))
    # the right side holds each set once, in another order and with a repeated element
    shuffled = firsts.select("first_order", F.concat(F.reverse("k"), F.slice("k", 1, 1)).alias("s"))
    return array_set_join(lists, shuffled, [], ["s"]).select("l_orderkey", "first_order")


@query(
    "array_equal_join",
    """
WITH a AS (SELECT l_orderkey, list_sort(list(l_suppkey)) AS s FROM lineitem GROUP BY l_orderkey)
SELECT r.l_orderkey, count(*) AS n FROM a l JOIN a r ON l.s = r.s GROUP BY r.l_orderkey""",
)
def _(t: Tables) -> DataFrame:
    lists = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_suppkey")).alias("s"))
    sizes = lists.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    return lists.join(sizes, "s").select("l_orderkey", "n")


# the last path segment of a page, up to '?', '#' or '.'; trailing slashes are cut
_SEGMENT = r"^.*?//[^/]+/(?:[^?#]*/)?([^/?#.]+)/?(?:[?#.].*)?$"


@query(
    "path_key_join",
    f"""
SELECT page_id, p_name AS part_name FROM (SELECT page_id, '/parts/' || regexp_replace(url, '{_SEGMENT}', '\\1') AS path FROM pages)
LEFT JOIN part ON split_part(path, '/', -1) = CAST(p_partkey AS VARCHAR)""",
)
def _(t: Tables) -> DataFrame:
    paths = t.pages.select("page_id", F.concat(F.lit("/parts/"), F.regexp_replace("url", _SEGMENT, "$1")).alias("path"))
    return path_key_join(paths, "path", t.part, "p_partkey", "p_name", "part_name").drop("path")


@query(
    "service_paths",
    f"""
WITH a AS (
  SELECT page_id, '/apps/' || regexp_replace(url, '{_SEGMENT}', '\\1') AS path_to, '/home/' || page_id AS path_from FROM pages
  UNION ALL SELECT page_id, '/news/' || page_id, '/home/' || page_id FROM pages
)
SELECT page_id AS user_id, path_to, path_from, b.p_name AS service_to_name, f.p_name AS service_from_name FROM a
LEFT JOIN part b ON split_part(path_to, '/', -1) = CAST(b.p_partkey AS VARCHAR)
LEFT JOIN part f ON split_part(path_from, '/', -1) = CAST(f.p_partkey AS VARCHAR) WHERE path_to ILIKE '%APPS%'""",
)
def _(t: Tables) -> DataFrame:
    def action(prefix: str, tail) -> DataFrame:
        return t.pages.select(
            F.col("url").alias("uuid"),
            F.col("page_id").alias("user_id"),
            F.lit("open").alias("action"),
            F.concat(F.lit("/home/"), F.col("page_id").cast("string")).alias("path_from"),
            F.concat(F.lit(prefix), tail).alias("path_to"),
            F.lit(None).cast("string").alias("user_agent"),
            F.lit(False).alias("is_bot"),
            F.lit(None).cast("timestamp_ntz").alias("create_ts"),
        )

    tail = F.regexp_replace("url", _SEGMENT, "$1")
    actions = action("/apps/", tail).unionByName(action("/news/", F.col("page_id").cast("string")))
    buttons = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    out = frontend_actions_services(actions, buttons)
    return out.select("user_id", "path_to", "path_from", "service_to_name", "service_from_name")


_LISTS_SQL = """
WITH lists AS (
  SELECT s_suppkey AS user_id, 'U' || s_suppkey AS full_name, 'NATION_' || s_nationkey || ', NATION_' || (s_nationkey + 1) % 25 || ', NATION_' || s_nationkey AS mails
  FROM supplier
)"""


def _lists(t: Tables) -> tuple[DataFrame, DataFrame]:
    nation = lambda c: F.concat(F.lit("NATION_"), c.cast("string"))
    key = F.col("s_nationkey")
    users = t.supplier.select(
        F.col("s_suppkey").alias("user_id"),
        F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("full_name"),
        F.concat_ws(", ", nation(key), nation(F.pmod(key + 1, F.lit(25))), nation(key)).alias("email"),
    )
    text = lambda c: F.lit(None).cast("string").alias(c)
    members = t.nation.select(
        text("first_name"), text("last_name"), text("type_of_learning"), text("rzd_status"), text("academic_level"),
        text("rzd_number"), F.col("n_nationkey").alias("card_id"), F.col("n_name").alias("card_number"), F.col("n_name").alias("email"),
    )
    return users, members


@query(
    "member_match",
    _LISTS_SQL
    + """ SELECT user_id AS userdata_user_id, n_nationkey AS card_id FROM lists JOIN nation
ON n_name IN (SELECT unnest(string_split(mails, ',')))""",
)
def _(t: Tables) -> DataFrame:
    return member_matches(*_lists(t)).select("userdata_user_id", "card_id")


@query(
    "member_match_trimmed",
    _LISTS_SQL
    + """ SELECT user_id AS userdata_user_id, n_nationkey AS card_id FROM lists JOIN nation
ON n_name IN (SELECT trim(unnest(string_split(mails, ','))))""",
)
def _(t: Tables) -> DataFrame:
    return member_matches(*_lists(t), trim=True).select("userdata_user_id", "card_id")


@query(
    "member_mart",
    _LISTS_SQL
    + """, fresh AS (
  SELECT full_name, user_id AS userdata_user_id, min(n_nationkey) AS card_id FROM lists JOIN nation
  ON n_name IN (SELECT trim(unnest(string_split(mails, ',')))) GROUP BY 1, 2
), stored AS (SELECT 'U' || c_custkey AS full_name, -1 AS userdata_user_id, -1 AS card_id FROM customer)
SELECT coalesce(s.full_name, f.full_name) AS full_name, coalesce(f.userdata_user_id, s.userdata_user_id) AS userdata_user_id,
       coalesce(f.card_id, s.card_id) AS card_id FROM stored s FULL JOIN fresh f ON s.full_name = f.full_name""",
)
def _(t: Tables) -> DataFrame:
    matches = member_matches(*_lists(t), trim=True)
    minus = F.lit(-1)
    known = {"full_name": F.concat(F.lit("U"), F.col("c_custkey").cast("string")), "userdata_user_id": minus, "card_id": minus}
    stored = t.customer.select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in matches.schema.fields]
    )
    return refresh_member_join(stored, matches).select("full_name", "userdata_user_id", "card_id")


@query(
    "latest_version_join",
    """
WITH v AS (SELECT l_orderkey, l_shipdate, l_partkey FROM lineitem)
SELECT o_orderkey, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM orders JOIN v ON o_orderkey = v.l_orderkey
WHERE l_shipdate = (SELECT max(l_shipdate) FROM v w WHERE w.l_orderkey = o_orderkey)""",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_partkey")
    out = latest_version_join(t.orders.select("o_orderkey"), lines, "o_orderkey", "l_orderkey", "l_shipdate")
    return out.select("o_orderkey", "l_partkey", day("l_shipdate").alias("shipped"))


@query(
    "correlated_latest",
    """
SELECT c_custkey, o_orderkey FROM customer JOIN orders ON o_custkey = c_custkey
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders i WHERE i.o_custkey = c_custkey)""",
)
def _(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    return latest_version_join(t.customer.select("c_custkey"), orders, "c_custkey", "o_custkey", "o_orderdate").select(
        "c_custkey", "o_orderkey"
    )


@query(
    "star_join",
    """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS event_id, l_returnflag AS name, p_name AS group_name,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS event_name, CASE WHEN s_acctbal > 0 THEN s_name END AS room_name,
       'a ' || c_mktsegment || ' ' || c_name AS lecturer_name
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN orders ON o_orderkey = l_orderkey
LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN customer ON c_custkey = o_custkey""",
)
def _(t: Tables) -> DataFrame:
    line = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    none = F.lit(None)
    events = t.lineitem.select(
        line.alias("id"), F.col("l_returnflag").alias("name"), F.lit(True).alias("odd"), F.lit(True).alias("even"),
        none.cast("int").alias("weekday"), none.cast("int").alias("num"), none.cast("string").alias("start"),
        none.cast("string").alias("end"), none.cast("string").alias("group"), "l_orderkey", "l_partkey", "l_suppkey",
    )

    def dim(df: DataFrame, key: str, mine, **cols) -> DataFrame:
        name = F.when(mine, "here").otherwise("elsewhere")
        return df.select(F.col(key).alias("id"), name.alias("source_name"), *[c.alias(n) for n, c in cols.items()])

    always = F.lit(True)
    groups = dim(t.part, "p_partkey", always, group_name_text=F.col("p_name"))
    lessons = dim(t.orders, "o_orderkey", F.col("o_orderstatus") != "P", event_name_text=F.col("o_orderpriority"))
    rooms = dim(t.supplier, "s_suppkey", F.col("s_acctbal") > 0, room_name=F.col("s_name"))
    people = dim(
        t.customer, "c_custkey", always, lecturer_first_name=F.lit("a"),
        lecturer_middle_name=F.col("c_mktsegment"), lecturer_last_name=F.col("c_name"),
    )
    link = lambda df, key, out: df.select(F.col("id").alias("event_id"), F.col(key).alias(out))
    # the part and the supplier belong to the line: make the ids of the lines tell them apart
    apart = F.concat_ws("/", line, F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    unique = events.withColumn("id", F.concat_ws("/", "id", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")))
    # the numbers meet the orders, and the text is made of them afterwards
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    to_customer = lines.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").select(apart.alias("id"), "o_custkey")
    mart = timetable_mart(
        unique, link(unique, "l_partkey", "group_id"), groups, link(unique, "l_orderkey", "lesson_id"), lessons,
        link(unique, "l_suppkey", "room_id"), rooms, link(to_customer, "o_custkey", "teacher_id"), people, "here",
    )
    return mart.select(
        F.split_part("event_id", F.lit("/"), F.lit(1)).alias("event_id"), "name", "group_name", "event_name", "room_name", "lecturer_name"
    )


@query(
    "comment_mart",
    """
WITH lecturer AS (
  SELECT c_custkey AS api_id, c_name AS last_name, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS subject,
         c_nationkey AS timetable_id, c_acctbal AS mark, DATE '2024-01-01' AS valid_from_dt,
         CASE WHEN c_mktsegment = 'FURNITURE' THEN DATE '2024-02-01' END AS valid_to_dt FROM customer
  UNION ALL SELECT c_custkey, 'old', c_mktsegment, 0, 0, DATE '2023-01-01', DATE '2024-01-01' FROM customer
), comment AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS api_uuid, o_custkey AS lecturer_id, repeat(o_orderpriority || '. ', 12) AS text, o_orderstatus, o_orderdate
  FROM orders
), link AS (
  SELECT o_custkey AS lecturer_id, o_orderkey AS user_id FROM orders WHERE o_totalprice > 100000
), users AS (SELECT o_orderkey AS user_id, 'U' || o_orderkey AS full_name, o_orderpriority AS email FROM orders WHERE o_totalprice > 200000)
SELECT c.api_uuid AS comment_api_uuid, l.api_id AS lecturer_api_id, max('x ' || l.last_name || ' y') AS lecturer_full_name,
       max(l.timetable_id) AS timetable_id, coalesce(max(l.subject), 'No subject') AS lecturer_subject,
       substring(max(c.text), 1, 80) AS comment_shortened_text, max(link.user_id) AS user_id, max(u.full_name) AS user_full_name,
       max(u.email) AS user_email, max(l.mark) AS mark_weighted, strftime(max(c.o_orderdate), '%Y-%m-%d') AS comment_create_ts
FROM comment c LEFT JOIN lecturer l ON c.lecturer_id = l.api_id LEFT JOIN link ON link.lecturer_id = l.api_id
LEFT JOIN users u ON link.user_id = u.user_id
WHERE l.valid_to_dt IS NULL AND l.valid_from_dt = (SELECT max(valid_from_dt) FROM lecturer i WHERE i.api_id = c.lecturer_id)
GROUP BY c.api_uuid, l.api_id, l.valid_from_dt""",
)
def _(t: Tables) -> DataFrame:
    date = lambda d: F.lit(d).cast("date")
    marks = lambda c: {m: c for m in ("mark_weighted", "mark_kindness_weighted", "mark_clarity_weighted", "mark_freebie_weighted")}
    segment = F.col("c_mktsegment")
    base = t.customer.select(
        F.col("c_custkey").alias("api_id"), F.lit("x").alias("first_name"), F.col("c_name").alias("last_name"),
        F.lit("y").alias("middle_name"), F.lit(None).cast("string").alias("avatar_link"), F.lit(0).alias("rank"),
        "c_nationkey", "c_mktsegment", "c_acctbal",
    )
    live = base.withColumns(
        {
            "subject": F.when(segment != "MACHINERY", segment),
            "timetable_id": F.col("c_nationkey"),
            **marks(F.col("c_acctbal")),
            "valid_from_dt": date("2024-01-01"),
            "valid_to_dt": F.when(segment == "FURNITURE", date("2024-02-01")),
        }
    )
    old = base.withColumns(
        {
            "last_name": F.lit("old"),
            "subject": segment,
            "timetable_id": F.lit(0),
            **marks(F.lit(0.0)),
            "valid_from_dt": date("2023-01-01"),
            "valid_to_dt": date("2024-01-01"),
        }
    )
    one = F.lit(1)
    comments = t.orders.select(
        F.col("o_orderkey").cast("string").alias("api_uuid"), F.col("o_orderdate").alias("create_ts"),
        F.col("o_orderdate").alias("update_ts"), F.lit(None).cast("string").alias("subject"),
        F.repeat(F.concat("o_orderpriority", F.lit(". ")), F.lit(12)).alias("text"),
        one.alias("mark_kindness"), one.alias("mark_freebie"), one.alias("mark_clarity"),
        F.col("o_custkey").alias("lecturer_id"), F.col("o_orderstatus").alias("review_status"),
        F.lit(None).cast("date").alias("valid_to_dt"),
    )
    links = t.orders.filter("o_totalprice > 100000").select(F.col("o_custkey").alias("lecturer_id"), F.col("o_orderkey").alias("user_id"))
    users = t.orders.filter("o_totalprice > 200000").select(
        F.col("o_orderkey").alias("user_id"),
        F.concat(F.lit("U"), F.col("o_orderkey").cast("string")).alias("full_name"),
        F.col("o_orderpriority").alias("email"),
    )
    mart = comment_mart(comments, live.unionByName(old), links, users)
    return mart.select(
        "comment_api_uuid", "lecturer_api_id", "lecturer_full_name", "timetable_id", "lecturer_subject", "comment_shortened_text",
        "user_id", "user_full_name", "user_email", "mark_weighted", day("comment_create_ts").alias("comment_create_ts"),
    )


_RENTAL_SQL = """
WITH strike AS (SELECT c_custkey AS user_id, c_mktsegment AS reason, c_nationkey AS at FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier),
session AS (SELECT o_custkey AS user_id, o_orderkey AS item_id, p_size AS type_id, n_name AS name, o_orderstatus AS status
  FROM orders LEFT JOIN part ON o_orderkey = p_partkey LEFT JOIN nation ON n_nationkey = p_size)
"""


def _rental(t: Tables) -> tuple[DataFrame, ...]:
    """Orders as sessions and as events of their customer, who has one strike or two."""
    none = F.lit(None)
    sessions = t.orders.select(
        none.cast("string").alias("uuid"), F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("item_id"),
        none.cast("int").alias("admin_open_id"), none.cast("int").alias("admin_close_id"),
        *[F.col("o_orderdate").alias(c) for c in ("reservation_ts", "start_ts", "end_ts", "actual_return_ts")],
        F.col("o_orderstatus").alias("status"),
    )
    items = t.part.select(F.col("p_partkey").alias("api_id"), F.col("p_size").alias("type_id"))
    types = t.nation.select(
        F.col("n_nationkey").alias("api_id"), F.col("n_name").alias("name"),
        none.cast("string").alias("image_url"), none.cast("string").alias("description"),
    )
    events = t.orders.select(F.col("o_custkey").alias("user_id"), F.lit(1).alias("session_id"), F.col("o_orderkey").alias("admin_id"))
    strike = lambda df, *cols: df.select(*[F.col(c).alias(out) for c, out in zip(cols, ("user_id", "reason", "create_ts"), strict=True)])
    strikes = strike(t.customer, "c_custkey", "c_mktsegment", "c_nationkey").unionByName(strike(t.supplier, "s_suppkey", "s_name", "s_nationkey"))
    return sessions, items, types, events, strikes


@query(
    "rental_fanout",
    _RENTAL_SQL
    + """SELECT s.user_id, item_id, type_id, name, status, e.o_orderkey AS admin_strike_id, k.reason AS strike_reason, k.at AS strike_date
FROM session s LEFT JOIN orders e ON e.o_custkey = s.user_id LEFT JOIN strike k ON k.user_id = s.user_id""",
)
def _(t: Tables) -> DataFrame:
    mart = rentals_mart(*_rental(t), compat=True)
    return mart.select("user_id", "item_id", "type_id", "name", "status", "admin_strike_id", "strike_reason", "strike_date")


@query(
    "rental_factors",
    _RENTAL_SQL
    + """SELECT s.*, (SELECT count(*) FROM orders WHERE o_custkey = s.user_id) AS n_events, (SELECT count(*) FROM strike k WHERE k.user_id = s.user_id) AS n_strikes
FROM session s""",
)
def _(t: Tables) -> DataFrame:
    return rentals_mart(*_rental(t)).select("user_id", "item_id", "type_id", "name", "status", "n_events", "n_strikes")

"""JSON payloads, webhooks, chat messages and container logs, built from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, moment, query
from sedimart.functions.jsontext import json_field
from sedimart.operators.logs import attach_container, parse_log, parse_processes
from sedimart.operators.payloads import chat_messages, code_label, explode_payload, issue_events, stamp_routes
from sedimart.plans.infra import container_log
from sedimart.plans.marketing import _routes, action_tables

# Payload forms by event type: a list of two, nothing, a plain object, an empty list, NULL.
_PAYLOAD_SQL = """
WITH actions AS (
  SELECT event_id, ts, CASE event_type WHEN 'view' THEN -1 WHEN 'signup' THEN -2 WHEN 'error' THEN -3 ELSE user_id + 1 END AS user_id,
         CASE WHEN value < 150 THEN event_type END AS action, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value,
         CASE WHEN value < 2 THEN 'empty' WHEN value < 4 THEN 'none' WHEN value < 6 THEN 'null' WHEN value < 40 THEN 'two' ELSE 'one' END AS form
  FROM events
), elems AS (
  SELECT *, unnest(CASE form WHEN 'none' THEN [] WHEN 'two' THEN [1, 2] ELSE [1] END) AS part FROM actions
), fields AS (
  SELECT *, CASE WHEN form IN ('one', 'two') AND part = 1 THEN CAST(k AS VARCHAR) END AS fk,
            CASE WHEN form = 'two' AND part = 2 THEN 'bot' || k END AS agent, form = 'two' AND part = 2 AS "full"
  FROM elems
)
"""


def actions(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    k = F.get_json_object("props", "$.k")
    n = k.cast("int")
    text = lambda prefix, value: F.concat(F.lit(prefix), value.cast("string"))
    full = {
        "user_agent": text("bot", n), "auth_user_id": F.when(n % 2 == 0, "Not auth").otherwise(n.cast("string")), "k": F.lit(None).cast("string"),
        "status": text("s", n % 3), "app_version": text("v", n % 4), "user_id": text("", n), "surname": text("name", n % 9), "number": text("#", n),
        "pin": F.when(n % 2 == 0, n.cast("string")).otherwise("none"), "status_code": F.when(n % 3 != 0, (200 + n % 3).cast("string")).otherwise("-1"),
        "description": F.when(n % 5 != 0, text("d", n)), "response_status_code": 200 + n % 5, "query": text("q=", n),
    }
    second = F.to_json(F.struct(*[c.alias(name) for name, c in full.items()]))
    payload = (
        F.when(value < 2, "")
        .when(value < 4, "[]")
        .when(value < 6, F.lit(None))
        .when(value < 40, F.concat(F.lit(" ["), F.col("props"), F.lit(", "), second, F.lit("]")))
        .otherwise(F.col("props"))
    )
    sentinel = F.when(kind == "view", -1).when(kind == "signup", -2).when(kind == "error", -3)
    return t.events.select(
        "event_id",
        sentinel.otherwise(F.col("user_id") + 1).alias("user_id"),
        F.when(value < 150, kind).alias("action"),
        F.concat(F.lit("/apps/"), k).alias("path_from"),
        F.concat(F.lit("/home/"), F.col("event_id").cast("string")).alias("path_to"),
        payload.alias("additional_data"),
        F.col("ts").alias("create_ts"),
    )


@query("payload_explode", _PAYLOAD_SQL + "SELECT event_id, fk AS k, agent AS user_agent FROM fields")
def _(t: Tables) -> DataFrame:
    rows = explode_payload(actions(t), "additional_data")
    return rows.select("event_id", json_field("elem", "k").alias("k"), json_field("elem", "user_agent").alias("user_agent"))


@query(
    "payload_frontend",
    _PAYLOAD_SQL
    + """SELECT user_id, action, '/home/' || event_id AS path_to, agent AS user_agent,
       form = 'two' AS is_bot, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS create_ts
FROM fields WHERE user_id > 0""",
)
def _(t: Tables) -> DataFrame:
    rows = action_tables(actions(t))["frontend_actions"]
    return rows.select("user_id", "action", "path_to", "user_agent", "is_bot", moment("create_ts").alias("create_ts"))


@query(
    "payload_printer",
    _PAYLOAD_SQL
    + """SELECT action, '/apps/' || k AS path_from, CASE WHEN "full" THEN 's' || k % 3 ELSE '' END AS status,
       CASE WHEN "full" THEN 'v' || k % 4 ELSE '' END AS app_version FROM fields WHERE user_id = -1""",
)
def _(t: Tables) -> DataFrame:
    return action_tables(actions(t))["printer_actions"].select("action", "path_from", "status", "app_version")


@query(
    "payload_typed",
    _PAYLOAD_SQL
    + """SELECT action, '/home/' || event_id AS path_to, CASE WHEN "full" AND k % 5 <> 0 THEN 'd' || k END AS description,
       CASE WHEN "full" AND k % 2 = 0 THEN k ELSE 0 END AS pin, CASE WHEN "full" AND k % 3 <> 0 THEN 200 + k % 3 END AS status_code,
       CASE WHEN "full" THEN 's' || k % 3 ELSE '' END AS status, CASE WHEN "full" THEN CAST(k AS VARCHAR) ELSE '' END AS user_id,
       CASE WHEN "full" THEN 'name' || k % 9 ELSE '' END AS surname, CASE WHEN "full" THEN '#' || k ELSE '' END AS number
FROM fields WHERE user_id = -2 AND action IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    rows = action_tables(actions(t))["printer_bots_actions"]
    return rows.select("action", "path_to", "description", "pin", "status_code", "status", "user_id", "surname", "number")


@query(
    "payload_rating",
    _PAYLOAD_SQL
    + """SELECT action, '/home/' || event_id AS path_to, CASE WHEN "full" THEN 200 + k % 5 ELSE 0 END AS response_status_code,
       CASE WHEN "full" AND k % 2 = 1 THEN k ELSE 0 END AS user_id, CASE WHEN "full" THEN 'q=' || k ELSE '' END AS query
FROM fields WHERE user_id = -3""",
)
def _(t: Tables) -> DataFrame:
    rows = action_tables(actions(t))["rating_actions"]
    return rows.select("action", "path_to", "response_status_code", "user_id", "query")


@query(
    "route_by_class",
    _PAYLOAD_SQL
    + """SELECT route, count(*) AS n, count(DISTINCT user_id) AS users FROM (
  SELECT user_id, CASE WHEN user_id > 0 THEN 'frontend' WHEN user_id = -1 THEN 'printer'
         WHEN user_id = -2 AND action IS NOT NULL THEN 'printer_bots' WHEN user_id = -3 THEN 'rating' END AS route FROM actions)
WHERE route IS NOT NULL GROUP BY route""",
)
def _(t: Tables) -> DataFrame:
    stamped = stamp_routes(actions(t), _routes())
    return stamped.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query(
    "json_path",
    """
SELECT event_type AS status, 'issue ' || event_id AS issue_title, CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS issue_id,
       CASE WHEN value > 50 THEN 'login' || user_id END AS assignee_login, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') AS created_at,
       strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS event_ts
FROM events WHERE event_type NOT IN ('error', 'view')""",
)
def _(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    user = F.struct(F.col("user_id").alias("id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("login"))
    assignee = F.when(
        F.col("value") > 50, F.struct(F.concat(F.lit("login"), F.col("user_id").cast("string")).alias("login"))
    )
    issue = F.struct(
        F.when(kind != "view", F.col("event_id")).alias("id"),
        F.concat(F.lit("issue "), F.col("event_id").cast("string")).alias("title"),
        user.alias("user"),
        assignee.alias("assignee"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    )
    hooks = t.events.select(
        F.when(kind == "error", "OTHER").otherwise("GITHUB").alias("system"),
        F.to_json(F.struct(kind.alias("action"), issue.alias("issue"))).alias("message"),
        F.col("ts").alias("event_ts"),
    )
    out = issue_events(hooks)
    return out.select(
        "status", "issue_title", "user_id", "issue_id", "assignee_login",
        moment("created_at").alias("created_at"), moment("event_ts").alias("event_ts"),
    )


@query(
    "chat_messages",
    """
SELECT CASE role WHEN 'user' THEN 'Questions' WHEN 'assistant' THEN 'Answers' ELSE 'Service chat' END AS thread_name,
       text AS message_text, 'conv' || conv_id AS sender_telegram_login, '2024-01-01 03:00:00.000000' AS message_ts
FROM conversations WHERE turn > 0""",
)
def _(t: Tables) -> DataFrame:
    reply = F.when(F.col("role") != "system", F.struct(F.col("role").alias("message_thread_id")))
    title = F.when(F.col("turn") > 0, "our Team Chat, main").otherwise("elsewhere")
    sender = F.struct(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("username"))
    message = F.struct(
        F.struct(title.alias("title")).alias("chat"),
        reply.alias("reply_to_message"),
        F.col("text"),
        sender.alias("from"),
    )
    hooks = t.conversations.select(
        F.lit("TELEGRAM").alias("system"),
        F.to_json(F.struct(message.alias("message"))).alias("message"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_ts"),
    )
    labels = [("user", "Questions", 1), ("assistant", "Answers", 2), ("user", "Never shown", 3)]
    mapping = t.spark.createDataFrame(labels, "code string, label string, position int")
    out = chat_messages(hooks, "team chat", mapping)
    return out.select("thread_name", "message_text", "sender_telegram_login", moment("message_ts").alias("message_ts"))


@query(
    "code_label",
    """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' WHEN '5-LOW' THEN 'never' ELSE 'some day' END AS label
FROM orders""",
)
def _(t: Tables) -> DataFrame:
    codes = [("1-URGENT", "now", 1), ("2-HIGH", "soon", 2), ("5-LOW", "never", 3), ("1-URGENT", "late", 4)]
    mapping = t.spark.createDataFrame(codes, "code string, label string, position int")
    return code_label(t.orders, "o_orderpriority", mapping, "some day").select("o_orderkey", "label")


# Log lines: clicks hold a JSON record with its own time, views one without, the rest plain text;
# errors are not JSON at all and signups lie in no container folder.
_LOG_SQL = """
WITH lines AS (
  SELECT event_id AS id, event_type, user_id, value, ts,
         CASE event_type WHEN 'click' THEN 'own' WHEN 'view' THEN 'plain' ELSE 'text' END AS form,
         CASE WHEN event_type = 'click' THEN date_trunc('day', ts) ELSE ts END AS create_ts,
         md5(CAST(user_id AS VARCHAR)) || md5('x' || user_id) AS container_id
  FROM events WHERE event_type NOT IN ('error', 'signup')
), parsed AS (
  SELECT id, container_id, strftime(create_ts, '%Y-%m-%d %H:%M:%S.%f') AS create_ts,
         CASE WHEN form = 'text' THEN 'line ' || id ELSE 'm' || id END AS message,
         CASE WHEN form <> 'text' THEN CASE WHEN value > 60 THEN 'error' ELSE 'info' END END AS level_name
  FROM lines
)"""


def raw_log(t: Tables) -> DataFrame:
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    level = F.when(F.col("value") > 60, "error").otherwise("info")
    message = F.concat(F.lit("m"), number)
    own = F.to_json(
        F.struct(
            F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
            level.alias("level_name"),
            message.alias("message"),
        )
    )
    plain = F.to_json(F.struct(level.alias("level_name"), message.alias("message")))
    # a NUL escape, as it stands in the inner text, is stripped
    text = F.concat(F.lit("line "), number, F.lit("\\u0000"))
    inner = F.when(kind == "click", own).when(kind == "view", plain).otherwise(text)
    outer = F.to_json(F.struct(inner.alias("log")))
    user = F.col("user_id").cast("string")
    folder = F.concat(F.md5(user.cast("binary")), F.md5(F.concat(F.lit("x"), user).cast("binary")))
    path = F.concat(F.lit("/var/lib/containers/"), folder, F.lit("/"), folder, F.lit("-json.log"))
    return t.events.select(
        F.col("event_id").alias("id"),
        F.when(kind == "error", "broken").otherwise(outer).alias("record"),
        F.when(kind == "signup", "short.log").otherwise(path).alias("logfile"),
        F.col("ts").alias("create_ts"),
    )


# Lines of a process list, on average at most.
LINES_A_LIST = 200


def raw_processes(t: Tables) -> DataFrame:
    """Process lists of some hundred lines each: each user's container, renamed on later days, few users missing.

    The users of a day are dealt into as many lists as their number asks for, so no list grows with it.
    """
    user = F.col("user_id").cast("string")
    short = F.left(F.md5(user.cast("binary")), F.lit(12))
    seen = t.events.filter("event_type <> 'purchase'").select(
        short.alias("short"), "user_id", F.date_trunc("day", "ts").alias("create_ts")
    ).distinct()
    days = seen.groupBy("create_ts").agg(F.ceil(F.count(F.lit(1)) / LINES_A_LIST).alias("lists"))
    line = F.concat(
        F.lit(" "), F.col("short"), F.lit("::image::name_"), F.col("user_id").cast("string"), F.lit("_"),
        F.dayofmonth("create_ts").cast("string"), F.lit("::Up::"), F.date_format("create_ts", "yyyy-MM-dd HH:mm:ss"),
    )
    dealt = seen.join(days, "create_ts").withColumn("list", F.pmod(F.xxhash64("user_id"), "lists"))
    lists = dealt.groupBy("create_ts", "list").agg(F.array_join(F.array_sort(F.collect_list(line)), "^").alias("body"))
    return lists.select(F.concat(F.lit(" "), F.col("body"), F.lit(" ^ ")).alias("record"), "create_ts")


def _shown(log: DataFrame) -> DataFrame:
    return log.select(
        *[c for c in log.columns if c not in ("record", "create_ts")],
        moment("create_ts").alias("create_ts"),
        F.get_json_object("record", "$.message").alias("message"),
        F.get_json_object("record", "$.level_name").alias("level_name"),
    )


@query("log_parse", _LOG_SQL + " SELECT * FROM parsed")
def _(t: Tables) -> DataFrame:
    return _shown(parse_log(raw_log(t)))


_PROCESS_SQL = """ processes AS (
  SELECT DISTINCT substr(md5(CAST(user_id AS VARCHAR)), 1, 12) AS container_id, 'image' AS image_name,
         'name_' || user_id || '_' || day(ts) AS container_name, 'Up' AS status, date_trunc('day', ts) AS seen
  FROM events WHERE event_type <> 'purchase'
)"""


@query(
    "process_list_parse",
    "WITH"
    + _PROCESS_SQL
    + """ SELECT container_id, image_name, container_name, status, strftime(seen, '%Y-%m-%d %H:%M:%S.%f') AS create_ts,
       strftime(seen, '%Y-%m-%d %H:%M:%S.%f') AS record_create_ts FROM processes""",
)
def _(t: Tables) -> DataFrame:
    return parse_processes(raw_processes(t)).withColumns({c: moment(c) for c in ("create_ts", "record_create_ts")})


_ATTACH_SQL = (
    _LOG_SQL
    + ","
    + _PROCESS_SQL
    + """, named AS (
  SELECT container_id, container_name FROM (
    SELECT *, row_number() OVER (PARTITION BY container_id ORDER BY seen DESC, container_name) AS rn FROM processes) WHERE rn = 1)
SELECT p.id, n.container_name, p.create_ts, p.message, p.level_name
FROM parsed p JOIN named n ON p.container_id LIKE '%' || n.container_id || '%'"""
)


@query("container_attach", _ATTACH_SQL)
def _(t: Tables) -> DataFrame:
    return _shown(container_log(raw_log(t), raw_processes(t)))


@query(
    "container_log_counts",
    f"SELECT container_name, count(*) AS n, count(CASE WHEN level_name = 'error' THEN 1 END) AS errors FROM ({_ATTACH_SQL}) GROUP BY container_name",
)
def _(t: Tables) -> DataFrame:
    # here the containers come from the parsed rows themselves
    log = attach_container(parse_log(raw_log(t)), parse_processes(raw_processes(t)))
    level = F.get_json_object("record", "$.level_name")
    return log.groupBy("container_name").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(level == "error", 1)).alias("errors"))

"""Instances of the warehouse's tables over the given ones: typed refreshes, histories, dimensions, links and resolved lessons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, DoubleType, StructField, StructType

from sedimart.catalog.linking_queries import _TOKENS
from sedimart.catalog.registry import Tables, day, moment, query
from sedimart.functions.fixed import NEW_GROUP_NAME, NEW_LECTURER_DESCRIPTION
from sedimart.plans.auth import ACCOUNT_COLUMNS, METHOD_COLUMNS, account_history, method_history
from sedimart.plans.rating import COMMENT_COLUMNS, LECTURER_COLUMNS, MARKS, dwh_comment, dwh_lecturer, ods_comment, ods_lecturer_user_comment
from sedimart.plans.rental import TABLES, dwh_table, ods_table
from sedimart.session import materialize
from sedimart.plans.timetable import dim_event, dim_group, dim_lecturer, dim_room, lessons_to_ids, link_table, timetable_mart

# Raw tables as expressions that both engines read alike, made of a given table. {edit} holds for rows that
# the second day changes.
_RENTAL = {
    "event": ("events", "event_id", {
        "user_id": "user_id", "admin_id": "event_id % 7", "session_id": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id % 50 END",
        "action_type": "event_type", "details": "CASE WHEN {edit} THEN 'edited' ELSE props END", "create_ts": "ts",
    }),
    "item": ("part", "p_partkey", {"type_id": "CASE WHEN {edit} THEN p_size + 100 ELSE p_size END", "is_available": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice > 1000 END"}),
    "item_type": ("part", "p_partkey", {
        "name": "p_name", "image_url": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 'http://i/' || p_brand END", "description": "CASE WHEN {edit} THEN 'edited' ELSE p_type END",
    }),
    "rental_session": ("orders", "o_orderkey", {
        "user_id": "o_custkey", "item_id": "o_orderkey % 90", "admin_open_id": "o_custkey % 5", "admin_close_id": "CASE WHEN {edit} THEN NULL ELSE o_custkey % 3 END",
        "reservation_ts": "o_orderdate", "start_ts": "o_orderdate", "end_ts": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END", "actual_return_ts": "o_orderdate", "status": "o_orderstatus",
    }),
    "strike": ("events", "event_id", {
        "user_id": "user_id", "session_id": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 40 END", "admin_id": "event_id % 3", "reason": "CASE WHEN {edit} THEN NULL ELSE event_type END", "create_ts": "ts",
    }),
}
_COMMENT = ("orders", "o_orderkey", {
    "create_ts": "o_orderdate", "update_ts": "o_orderdate", "subject": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END", "text": "CASE WHEN {edit} THEN 'edited' ELSE o_orderstatus END",
    "mark_kindness": "o_orderkey % 5 - 2", "mark_freebie": "o_orderkey % 4 - 2", "mark_clarity": "o_custkey % 5 - 2", "lecturer_id": "o_custkey", "review_status": "o_orderstatus",
})
_LECTURER = ("customer", "c_custkey", {
    "first_name": "c_mktsegment", "last_name": "c_name", "middle_name": "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'M' END", "subject": "CASE WHEN {edit} THEN NULL ELSE c_mktsegment END",
    "avatar_link": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'http://a/' || c_name END", "timetable_id": "c_nationkey",
    **{m: f"CAST(c_acctbal + {k} AS DOUBLE)" for k, m in enumerate(MARKS)},
})
_METHOD = ("orders", "o_orderkey", {
    "user_id": "o_custkey", "auth_method": "o_orderpriority", "param": "CASE WHEN o_orderkey % 2 = 0 THEN 'email' ELSE 'token' END", "value": "CASE WHEN {edit} THEN 'edited' ELSE o_orderstatus END",
    "create_ts": "o_orderdate", "update_ts": "CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END", "is_deleted": "o_totalprice > 200000",
})
_ACCOUNT = ("orders", "o_orderkey", {"create_ts": "o_orderdate", "update_ts": "CASE WHEN {edit} THEN NULL ELSE o_orderdate END", "is_deleted": "o_totalprice > 200000"})
_USER_COMMENT = ("orders", "o_orderkey", {"lecturer_id": "o_custkey", "user_id": "o_custkey % 70", "create_ts": "o_orderdate", "update_ts": "CASE WHEN {edit} THEN NULL ELSE o_orderdate END"})

Raw = tuple[str, str, dict[str, str]]
FIRST, SECOND = "2024-01-01", "2024-02-01"


def _edit(key: str, second: bool) -> str:
    return f"{key} % 10 = 3" if second else "1 = 0"


def raw_table(t: Tables, raw: Raw, second: bool = False, id_col: str = "id") -> DataFrame:
    """A raw table as of the first day, or of the second: some rows changed, some gone, some new."""
    table, key, columns = raw
    rows = getattr(t, table).where(f"{key} % 17 <> 2" if second else f"{key} % 7 <> 1")
    return rows.selectExpr(f"{key} AS {id_col}", *[f"{e.format(edit=_edit(key, second))} AS {c}" for c, e in columns.items()])


def _raw_sql(raw: Raw, second: bool, as_key: Callable[[str], str], stamped: bool, moved: bool) -> str:
    """The same in SQL, typed: the key first, then the surrogate id if ``stamped``; times moved to Moscow if ``moved``."""
    table, key, columns = raw

    def column(c: str, e: str) -> str:
        e = e.format(edit=_edit(key, second))
        if not c.endswith("_ts"):
            return f"{e} AS {c}"
        e = f"timezone('Europe/Moscow', timezone('UTC', {e}))" if moved else e
        return f"strftime({e}, '%Y-%m-%d %H:%M:%S.%f') AS {c}"

    own = [as_key(key), *([f"sha256(CAST({key} AS VARCHAR)) AS uuid"] if stamped else [])]
    where = f"{key} % 17 <> 2" if second else f"{key} % 7 <> 1"
    return f"SELECT {', '.join(own)}, {', '.join(column(c, e) for c, e in columns.items())} FROM {table} WHERE {where}"


def _shown(df: DataFrame) -> DataFrame:
    dates = {c: day(c) for c in ("valid_from_dt", "valid_to_dt") if c in df.columns}
    return df.withColumns({c: moment(c) for c in df.columns if c.endswith("_ts")} | dates)


def _history(name: str, raw: Raw, key: str, typed: Callable[[DataFrame], DataFrame] | None, apply: Callable, text_key: bool = False, id_col: str = "id", rank: bool = False) -> None:
    """Register the history of one table: the first day loaded into an empty one, then the second."""
    as_key = lambda k: f"CAST({k} AS VARCHAR) AS {key}" if text_key else f"{k} AS {key}"
    one, two = (_raw_sql(raw, second, as_key, typed is not None or rank, typed is not None) for second in (False, True))
    columns = [key, *(["uuid"] if typed or rank else []), *raw[2]]
    pick = lambda a: ", ".join([f"{a}.{c}" for c in columns] + (["0.0::double AS rank"] if rank else []))
    same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in [key, *raw[2]])
    sql = f"""WITH one AS ({one}), two AS ({two})
SELECT {pick('a')}, '{FIRST}' AS valid_from_dt, CASE WHEN NOT ({same}) THEN '{SECOND}' END AS valid_to_dt FROM one a LEFT JOIN two b ON a.{key} = b.{key}
UNION ALL SELECT {pick('b')}, '{SECOND}', NULL FROM two b LEFT JOIN one a ON a.{key} = b.{key} WHERE NOT ({same})"""

    @query(name, sql)
    def _(t: Tables) -> DataFrame:
        def snapshot(second: bool) -> DataFrame:
            rows = raw_table(t, raw, second, id_col)
            if text_key:
                rows = rows.withColumn(id_col, F.col(id_col).cast("string"))
            if rank:
                rows = rows.withColumn("uuid", F.sha2(F.col(id_col).cast("string"), 256))
            return typed(rows) if typed else rows

        first = snapshot(False)
        more = [StructField("rank", DoubleType())] if rank else []
        empty = t.spark.createDataFrame([], StructType([*first.schema.fields, *more, StructField("valid_from_dt", DateType()), StructField("valid_to_dt", DateType())]))
        stored = materialize(apply(empty, first, FIRST))  # stands for the stored table
        return _shown(apply(stored, snapshot(True), SECOND))


for _name in TABLES:
    _history(f"history_{_name}", _RENTAL[_name], "api_id", lambda raw, n=_name: ods_table(n, raw), lambda hist, snap, ds, n=_name: dwh_table(n, hist, snap, ds))
_history("history_comment", _COMMENT, "api_uuid", ods_comment, dwh_comment, text_key=True, id_col="uuid")
_history("history_lecturer", _LECTURER, "api_id", None, dwh_lecturer, id_col="api_id", rank=True)
_history("history_auth_method", _METHOD, "id", None, method_history)
_history("history_account", _ACCOUNT, "id", None, account_history)

assert set(COMMENT_COLUMNS) == set(_COMMENT[2]) and set(LECTURER_COLUMNS) == set(_LECTURER[2]) and set(METHOD_COLUMNS) == set(_METHOD[2]) and set(ACCOUNT_COLUMNS) == set(_ACCOUNT[2])


# --- typed refreshes


def _typed(name: str, raw: Raw, key: str, typed: Callable[[DataFrame], DataFrame], text_key: bool = False, id_col: str = "id") -> None:
    as_key = lambda k: f"CAST({k} AS VARCHAR) AS {key}" if text_key else f"{k} AS {key}"

    @query(name, _raw_sql(raw, True, as_key, True, True))
    def _(t: Tables) -> DataFrame:
        rows = raw_table(t, raw, True, id_col)
        return _shown(typed(rows.withColumn(id_col, F.col(id_col).cast("string")) if text_key else rows))


for _name in TABLES:
    _typed(f"typed_{_name}", _RENTAL[_name], "api_id", lambda raw, n=_name: ods_table(n, raw))
_typed("typed_comment", _COMMENT, "api_uuid", ods_comment, text_key=True, id_col="uuid")
_typed("typed_lecturer_user_comment", _USER_COMMENT, "api_id", ods_lecturer_user_comment)


# --- dimensions of the timetable

SOURCE = "api"
_ID = lambda *cols: f"sha256(concat_ws(chr(1), '{SOURCE}', {', '.join(cols)}))"
_LIVE = "FROM part WHERE p_type <> 'PROMO'"
_DIM_SQL = {
    "dim_event": f"SELECT p_name AS event_name_text, min(p_partkey) AS event_api_id, {_ID('p_name')} AS id, '{SOURCE}' AS source_name {_LIVE} GROUP BY p_name",
    "dim_group": f"""SELECT n || b AS group_name_text, n AS group_number, min(k) AS group_api_id, {_ID('n || b', 'n')} AS id, '{SOURCE}' AS source_name
FROM (SELECT split_part(p_name, ' ', 1) AS n, p_brand AS b, p_partkey AS k {_LIVE}) GROUP BY n, n || b""",
    "dim_room": f"""SELECT split_part(p_name, ' ', 2) AS room_name, p_brand AS room_department, p_type AS room_direction_text_type, min(p_partkey) AS room_api_id,
       {_ID("split_part(p_name, ' ', 2)", 'p_brand', 'p_type')} AS id, '{SOURCE}' AS source_name {_LIVE} GROUP BY 1, 2, 3""",
    "dim_lecturer": f"""SELECT p_name AS lecturer_first_name, p_type AS lecturer_middle_name, p_brand AS lecturer_last_name, min(p_partkey) AS lecturer_api_id, min(p_size) AS lecturer_avatar_id,
       min('d' || p_size) AS lecturer_description, {_ID('p_name', 'p_type', 'p_brand')} AS id, '{SOURCE}' AS source_name {_LIVE} GROUP BY 1, 2, 3""",
}


def dimensions(t: Tables) -> dict[str, DataFrame]:
    parts = t.part.withColumn("is_deleted", F.col("p_type") == "PROMO").withColumnRenamed("p_partkey", "id")
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    return {
        "dim_event": dim_event(parts.withColumn("name", F.col("p_name")), SOURCE),
        "dim_group": dim_group(parts.withColumns({"number": word(1), "name": F.col("p_brand")}), SOURCE),
        "dim_room": dim_room(parts.withColumns({"name": word(2), "building": F.col("p_brand"), "direction": F.col("p_type")}), SOURCE),
        "dim_lecturer": dim_lecturer(parts.withColumns({"first_name": F.col("p_name"), "middle_name": F.col("p_type"), "last_name": F.col("p_brand"), "avatar_id": F.col("p_size"), "description": F.concat(F.lit("d"), F.col("p_size").cast("string"))}), SOURCE),
    }


for _name, _sql in _DIM_SQL.items():
    query(_name, _sql)(lambda t, n=_name: dimensions(t)[n])


# --- links, and the mart they lead to

_COVERED = lambda q, d: f"(len({_TOKENS.format(q)}) > 0 AND len(list_filter({_TOKENS.format(q)}, lambda w: NOT list_contains({_TOKENS.format(d)}, w))) = 0)"


def _best(name: str, dim: str, column: str) -> str:
    return f"""{name} AS (SELECT event_id, dim_id FROM (
  SELECT e.id AS event_id, d.id AS dim_id, row_number() OVER (PARTITION BY e.id ORDER BY {_COVERED(column, 'name')} DESC, d.id) AS place
  FROM events_ e JOIN {dim}_ d ON contains(lower(name), lower({column}))) WHERE place = 1)"""


_LINKED_SQL = f"""WITH {', '.join(f'{name}_ AS ({sql})' for name, sql in _DIM_SQL.items())},
events_ AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand || ' ' || p_name || ' ' || p_type AS name FROM part),
{_best('to_group', 'dim_group', 'group_number')}, {_best('to_room', 'dim_room', 'room_name')}, {_best('to_lecturer', 'dim_lecturer', 'lecturer_last_name')},
to_lesson AS (SELECT e.id AS event_id, coalesce((SELECT min(d.id) FROM dim_event_ d WHERE {_COVERED('d.event_name_text', 'e.name')}), (SELECT min(id) FROM dim_event_)) AS dim_id FROM events_ e)
"""


def _linked(t: Tables) -> tuple[DataFrame, dict[str, DataFrame], dict[str, DataFrame]]:
    events = t.part.select(F.col("p_partkey").cast("string").alias("id"), F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("name"))
    dims = dimensions(t)
    links = {
        "group_id": link_table(events, dims["dim_group"], "group_number", "group_id"),
        "room_id": link_table(events, dims["dim_room"], "room_name", "room_id"),
        "teacher_id": link_table(events, dims["dim_lecturer"], "lecturer_last_name", "teacher_id"),
        "lesson_id": link_table(events, dims["dim_event"], "event_name_text", "lesson_id", contains=False),
    }
    return events, dims, links


@query(
    "timetable_links",
    _LINKED_SQL
    + " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, event_id, dim_id, sha256(concat_ws(chr(1), event_id, dim_id)) AS id FROM {table}"
        for kind, table in (("group_id", "to_group"), ("room_id", "to_room"), ("teacher_id", "to_lecturer"), ("lesson_id", "to_lesson"))
    ),
)
def _(t: Tables) -> DataFrame:
    _events, _dims, links = _linked(t)
    stacked = [df.select(F.lit(kind).alias("kind"), "event_id", F.col(kind).alias("dim_id"), "id") for kind, df in links.items()]
    return stacked[0].unionByName(stacked[1]).unionByName(stacked[2]).unionByName(stacked[3])


@query(
    "timetable_end_to_end",
    _LINKED_SQL
    + """SELECT e.id AS event_id, e.name, g.group_name_text AS group_name, l.event_name_text AS event_name, r.room_name,
       t.lecturer_first_name || ' ' || t.lecturer_middle_name || ' ' || t.lecturer_last_name AS lecturer_name
FROM events_ e LEFT JOIN to_group a ON a.event_id = e.id LEFT JOIN dim_group_ g ON g.id = a.dim_id LEFT JOIN to_lesson b ON b.event_id = e.id LEFT JOIN dim_event_ l ON l.id = b.dim_id
LEFT JOIN to_room c ON c.event_id = e.id LEFT JOIN dim_room_ r ON r.id = c.dim_id LEFT JOIN to_lecturer d ON d.event_id = e.id LEFT JOIN dim_lecturer_ t ON t.id = d.dim_id""",
)
def _(t: Tables) -> DataFrame:
    events, dims, links = _linked(t)
    slots = {"odd": "boolean", "even": "boolean", "weekday": "int", "num": "int", "start": "string", "end": "string", "group": "string"}
    timed = events.withColumns({c: F.lit(None).cast(kind) for c, kind in slots.items()})
    mart = timetable_mart(
        timed, links["group_id"], dims["dim_group"], links["lesson_id"], dims["dim_event"], links["room_id"], dims["dim_room"], links["teacher_id"], dims["dim_lecturer"], SOURCE
    )
    return mart.select("event_id", "name", "group_name", "event_name", "room_name", "lecturer_name")


# --- names to ids in lessons: rooms, groups and lecturers, the last two made where they are unknown

_LESSON_SQL = """WITH line AS (
  SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i, CASE WHEN p_type = 'PROMO' THEN 'no such room' ELSE p_name END AS place,
         'G' || l_suppkey AS grp, 'Last' || l_partkey % 300 || CASE WHEN l_linenumber % 2 = 0 THEN ' Ann  Bea' ELSE ' A. B.' END AS teacher, 'Last' || l_partkey % 300 || ' A B' AS teacher_key
  FROM lineitem JOIN part ON p_partkey = l_partkey
), rooms AS (SELECT p_name AS name, min(p_partkey) AS id FROM part GROUP BY p_name),
grps AS (SELECT 'G' || s_suppkey AS number, min(s_suppkey) AS id FROM supplier WHERE s_nationkey < 15 GROUP BY 1),
people AS (SELECT 'Last' || c_custkey % 400 || CASE WHEN c_nationkey % 2 = 0 THEN ' A B' ELSE ' O B' END AS key, min(c_custkey) AS id FROM customer GROUP BY 1)
"""


def _lessons(t: Tables) -> tuple[DataFrame, dict[str, DataFrame]]:
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    teacher = F.concat(text("Last", F.col("l_partkey") % 300), F.when(F.col("l_linenumber") % 2 == 0, " Ann  Bea").otherwise(" A. B."))
    room = F.when(F.col("p_type") == "PROMO", "no such room").otherwise(F.col("p_name"))
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", room.alias("place"), text("G", F.col("l_suppkey")).alias("group"), teacher.alias("teacher"))
    lists = lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    lessons = lists.select("id", *[F.transform("lines", _field(c)).alias(c) for c in ("place", "group", "teacher")])
    rooms = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    groups = t.supplier.filter("s_nationkey < 15").select(F.col("s_suppkey").alias("id"), text("G", F.col("s_suppkey")).alias("number"), F.col("s_name").alias("name"))
    first = F.when(F.col("c_nationkey") % 2 == 0, "Anna").otherwise("Olga")
    lecturers = t.customer.select(F.col("c_custkey").alias("id"), first.alias("first_name"), F.lit("Boris").alias("middle_name"), text("Last", F.col("c_custkey") % 400).alias("last_name"), F.lit(None).cast("string").alias("description"))
    return lessons_to_ids(lessons, rooms, groups, lecturers)


def _field(name: str) -> Callable:
    return lambda x: x[name]


@query(
    "lessons_to_ids",
    _LESSON_SQL
    + """SELECT line.id, string_agg(CASE WHEN place = 'no such room' THEN '-100' ELSE CAST(rooms.id AS VARCHAR) END, '|' ORDER BY i) AS place,
       string_agg(coalesce(CAST(grps.id AS VARCHAR), 'new ' || grp), '|' ORDER BY i) AS "group", string_agg(coalesce(CAST(people.id AS VARCHAR), 'new ' || teacher_key), '|' ORDER BY i) AS teacher
FROM line LEFT JOIN rooms ON rooms.name = place LEFT JOIN grps ON number = grp LEFT JOIN people ON key = teacher_key GROUP BY line.id""",
)
def _(t: Tables) -> DataFrame:
    """Ids of rows that were there, and the names of rows that were made, found again by their ids."""
    done, lacking = _lessons(t)
    made = lacking["groups"].select(F.col("id").alias("made"), F.col("number").alias("label"))
    people = lacking["lecturers"].select(F.col("id").alias("made"), F.concat_ws(" ", "last_name", "first_name", "middle_name").alias("label"))

    def told(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
        opened = df.select("id", F.posexplode(column).alias("i", "found")).join(names, F.col("found") == F.col("made"), "left")
        text = F.coalesce(F.concat(F.lit("new "), F.col("label")), F.col("found").cast("string"))
        back = opened.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", text.alias("text")))).alias("texts"))
        return df.drop(column).join(back.select("id", F.array_join(F.transform("texts", _field("text")), "|").alias(column)), "id")

    done = done.withColumn("place", F.array_join(F.col("place").cast("array<string>"), "|"))
    return told(told(done, "group", made), "teacher", people)


@query(
    "lessons_created",
    _LESSON_SQL
    + f"""SELECT DISTINCT 'room' AS kind, place AS name, NULL AS about FROM line WHERE place = 'no such room'
UNION ALL SELECT DISTINCT 'group', '{NEW_GROUP_NAME}' || grp, grp FROM line WHERE grp NOT IN (SELECT number FROM grps)
UNION ALL SELECT DISTINCT 'lecturer', teacher_key, '{NEW_LECTURER_DESCRIPTION}' FROM line WHERE teacher_key NOT IN (SELECT key FROM people)""",
)
def _(t: Tables) -> DataFrame:
    _done, lacking = _lessons(t)
    rooms = lacking["rooms"].select(F.lit("room").alias("kind"), "name", F.lit(None).cast("string").alias("about"))
    groups = lacking["groups"].select(F.lit("group").alias("kind"), "name", F.col("number").alias("about"))
    people = lacking["lecturers"].select(F.lit("lecturer").alias("kind"), F.concat_ws(" ", "last_name", "first_name", "middle_name").alias("name"), F.col("description").alias("about"))
    return rooms.unionByName(groups).unionByName(people)

"""Profiles and member records built from customers: the wide tables, the person merge and its attribute tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.catalog.registry import Tables, day, query
from sedimart.functions.fixed import MEMBER_SOURCE, NAME_PARAM, PERSON_PARAMS, PROFILE_PARAMS
from sedimart.operators.people import COMPLETENESS, SATELLITES, SHARED, USER_ONLY, Satellite, combine, member_table, merge_satellites, person_facts, satellite_rows, user_table
from sedimart.plans.userdata import auth_user, member_cards, refresh_auth_user, refresh_user_info, user_info
from sedimart.session import materialize

PARAMS = list(PERSON_PARAMS)
NAME, STUDENT, BIRTHDAY, MAIL = (PARAMS.index(p) for p in (NAME_PARAM, "Номер студенческого билета", "Дата рождения", "Электронная почта"))

# Every customer is a user with up to 23 attributes from two sources; two in three are members too, spelled
# otherwise, some in translation only, and one in ten of them twice.
_FACTS_SQL = f"""
WITH words AS (
  SELECT c_custkey AS id, c_nationkey AS nation, 'First' || c_nationkey AS f, 'Last' || (c_custkey % 100000) AS l, 'Mid' || length(c_mktsegment) AS m FROM customer
), named AS (
  SELECT id, nation, CASE nation % 4 WHEN 0 THEN f || ' ' || l WHEN 1 THEN l || '  ' || f || ' ' || m WHEN 2 THEN f || ' ' || m || ' ' || l ELSE m || ' ' || m END AS name FROM words
), wide AS (
  SELECT id, nation, i, CASE
    WHEN i = {NAME} THEN name
    WHEN i = {STUDENT} THEN CASE WHEN id % 13 = 0 THEN ' ' ELSE 'S' || id END
    WHEN i = {BIRTHDAY} THEN CASE nation % 3 WHEN 0 THEN '0' || (1 + id % 9) || '.05.1999' WHEN 1 THEN '1999-05-0' || (1 + id % 9) ELSE 'unknown' END
    WHEN i = {MAIL} THEN 'u' || id || '@x'
    WHEN (id + i) % 11 = 0 THEN ' ' ELSE 'v' || i || '-' || (id * (i + 3)) % 89 END AS value
  FROM named, range({len(PARAMS)}) t(i)
), facts AS (
  SELECT id AS user_id, i, 'user' AS source, value FROM wide WHERE (id + i) % 4 <> 0 OR i IN ({NAME}, {STUDENT})
  UNION ALL
  SELECT id, i, 'admin', CASE WHEN nation % 2 = 0 THEN value ELSE value || ' x' END FROM wide WHERE (id + i) % 5 = 0 AND i <> {STUDENT}
)"""


def profile(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(info, param, source) as the profile service holds them."""
    identity, nation, i = F.col("c_custkey"), F.col("c_nationkey"), F.col("i")
    text = lambda c: c.cast("string")
    first, last = F.concat(F.lit("First"), text(nation)), F.concat(F.lit("Last"), text(identity % 100_000))
    middle = F.concat(F.lit("Mid"), text(F.length("c_mktsegment")))
    name = (
        F.when(nation % 4 == 0, F.concat_ws(" ", first, last)).when(nation % 4 == 1, F.concat_ws(" ", last, F.lit(""), first, middle))
        .when(nation % 4 == 2, F.concat_ws(" ", first, middle, last)).otherwise(F.concat_ws(" ", middle, middle))
    )
    digit = text(1 + identity % 9)
    born = F.when(nation % 3 == 0, F.concat(F.lit("0"), digit, F.lit(".05.1999"))).when(nation % 3 == 1, F.concat(F.lit("1999-05-0"), digit)).otherwise("unknown")
    value = (
        F.when(i == NAME, name)
        .when(i == STUDENT, F.when(identity % 13 == 0, " ").otherwise(F.concat(F.lit("S"), text(identity))))
        .when(i == BIRTHDAY, born)
        .when(i == MAIL, F.concat(F.lit("u"), text(identity), F.lit("@x")))
        .when((identity + i) % 11 == 0, " ")
        .otherwise(F.concat(F.lit("v"), text(i), F.lit("-"), text((identity * (i + 3)) % 89)))
    )
    wide = t.customer.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(PARAMS) - 1)))).select(identity.alias("owner_id"), i.alias("param_id"), nation.alias("n"), value.alias("value"))
    owner, at = F.col("owner_id"), F.col("param_id")
    mine = wide.filter(((owner + at) % 4 != 0) | at.isin(NAME, STUDENT)).withColumn("source_id", F.lit(1))
    theirs = wide.filter(((owner + at) % 5 == 0) & (at != STUDENT)).withColumn("source_id", F.lit(2))
    theirs = theirs.withColumn("value", F.when(F.col("n") % 2 == 0, F.col("value")).otherwise(F.concat("value", F.lit(" x"))))
    param = t.spark.createDataFrame(list(enumerate(PARAMS)), "id int, name string")
    source = t.spark.createDataFrame([(1, "user"), (2, "admin")], "id int, name string")
    return mine.unionByName(theirs).drop("n"), param, source


def _pick_sql(i: int, value: str = "value") -> str:
    picked = f"CASE WHEN i = {i} THEN {value} END"
    return f"string_agg(DISTINCT {picked}, ', ' ORDER BY {picked})"


# --- wide profile tables

_WIDE = ", ".join(f'{_pick_sql(PARAMS.index(p))} AS "{c}"' for p, c in PROFILE_PARAMS.items())
_STORED_SQL = f"""{_FACTS_SQL}, fresh AS (SELECT user_id, {_WIDE} FROM facts GROUP BY user_id),
stored AS (SELECT s_suppkey * 20 AS user_id, {', '.join(f"'old' AS " + chr(34) + c + chr(34) for c in PROFILE_PARAMS.values())} FROM supplier)
"""


def _stored_profiles(t: Tables) -> DataFrame:
    """Profiles of an earlier run: some of users that are gone by now."""
    return t.supplier.select((F.col("s_suppkey") * 20).alias("user_id"), *[F.lit("old").alias(c) for c in PROFILE_PARAMS.values()])


@query("user_info", _STORED_SQL + "SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE user_id NOT IN (SELECT user_id FROM fresh)")
def _(t: Tables) -> DataFrame:
    info, param, _source = profile(t)
    return refresh_user_info(_stored_profiles(t), info, param)


@query(
    "auth_user_refresh",
    _STORED_SQL
    + f""", methods AS (SELECT o_custkey AS user_id, CASE WHEN o_orderkey % 3 = 0 THEN 'email' ELSE 'token' END AS param, 'a' || o_orderkey % 50 AS value FROM orders),
auth AS (SELECT user_id, string_agg(DISTINCT CASE WHEN param = 'email' THEN value END, ', ' ORDER BY CASE WHEN param = 'email' THEN value END) AS auth_email FROM methods GROUP BY user_id),
now AS (SELECT fresh.*, auth_email, CASE WHEN auth.user_id IS NOT NULL THEN c_acctbal < 0 END AS is_deleted
  FROM fresh LEFT JOIN auth USING (user_id) LEFT JOIN customer ON c_custkey = auth.user_id)
SELECT user_id AS id, * EXCLUDE (user_id) FROM now
UNION ALL BY NAME
SELECT user_id AS id, * EXCLUDE (user_id), 'old@x' AS auth_email, true AS is_deleted FROM stored WHERE user_id NOT IN (SELECT user_id FROM now)""",
)
def _(t: Tables) -> DataFrame:
    info, param, _source = profile(t)
    kind = F.when(F.col("o_orderkey") % 3 == 0, "email").otherwise("token")
    methods = t.orders.select(F.col("o_custkey").alias("user_id"), kind.alias("param"), F.concat(F.lit("a"), (F.col("o_orderkey") % 50).cast("string")).alias("value"))
    accounts = t.customer.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") < 0).alias("is_deleted"))
    stored = _stored_profiles(t).withColumnRenamed("user_id", "id").withColumns({"auth_email": F.lit("old@x"), "is_deleted": F.lit(True)})
    return refresh_auth_user(stored, auth_user(user_info(info, param), methods, accounts))


@query(
    "member_cards",
    _STORED_SQL + "SELECT user_id AS userdata_user_id, 'c' || s_suppkey AS card_id, s_nationkey AS card_number FROM fresh JOIN supplier ON split_part(email, ',', 1) = 'u' || s_suppkey || '@x'",
)
def _(t: Tables) -> DataFrame:
    info, param, _source = profile(t)
    mail = F.concat(F.lit("u"), F.col("s_suppkey").cast("string"), F.lit("@x"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("first_name", "last_name", "type_of_learning", "rzd_status", "academic_level", "rzd_number")]
    members = t.supplier.select(*nothing, F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("card_id"), F.col("s_nationkey").alias("card_number"), mail.alias("email"))
    return member_cards(user_info(info, param), members)


# --- person merge

# column -> (SQL, columns of the customer it is made of) of a full member record
_MEMBER_SQL = {
    "type_of_learning": "CASE WHEN n % 4 = 1 THEN NULL ELSE 'form-' || n % 3 END",
    "academic_level": "'v9-' || (id * 12) % 89",
    "faculty": "CASE WHEN id % 6 = 1 THEN NULL ELSE 'faculty-' || n % 7 END",
    "faculty_translated": "CASE WHEN id % 4 = 1 THEN NULL ELSE 'Faculty ' || n % 7 END",
    "email": "CASE WHEN id % 8 < 4 THEN 'u' || id || '@x' ELSE 'm' || id || '@y' END",
    "date_of_birth": "CASE id % 3 WHEN 1 THEN '1999-06-0' || (1 + id % 9) || 'T00:00' ELSE '06/1999' END",
    "phone_number": "CASE WHEN id % 5 = 1 THEN NULL ELSE '+7' || id END",
    "image": "CASE WHEN id % 2 = 0 THEN NULL ELSE 'http://p/' || id END",
    "rzd_status": "CASE WHEN id % 5 = 2 THEN NULL ELSE 'sent' END",
    "rzd_number": "CASE WHEN id % 7 = 2 THEN ' ' ELSE 'R' || id END",
    "rzd_datetime": "CASE WHEN id % 11 = 2 THEN NULL ELSE '2024-01-1' || id % 9 END",
    "status": "CASE WHEN id % 4 = 2 THEN NULL ELSE 'member' || n % 2 END",
    "status_gain_date": "CASE WHEN id % 9 = 4 THEN NULL WHEN id % 9 = 5 THEN '' ELSE '2023-0' || (1 + id % 9) || '-01' END",
    "card_id": "CASE WHEN id % 10 = 4 THEN NULL ELSE id * 7 END",
    "card_status": "CASE WHEN id % 2 = 1 THEN 'ok' ELSE 'lost' END",
    "card_date": "'2024-02-0' || (1 + id % 9)",
    "card_number": "id * 11",
    "card_user": "CASE WHEN id % 12 = 5 THEN '' ELSE 'holder ' || id END",
}
_MEMBERS_SQL = f"""
members AS (
  SELECT id, 'S' || id AS student_id, CASE WHEN n % 5 = 4 THEN 'Имя' ELSE 'first' || n END AS first_name, CASE WHEN id % 2 = 0 THEN 'Mid' END AS middle_name,
         ' LAST' || id % 100000 AS last_name, CASE WHEN n % 5 > 2 THEN 'FIRST' || n END AS first_name_translated, NULL AS middle_name_translated,
         'last' || id % 100000 AS last_name_translated, {', '.join(f'{sql} AS {c}' for c, sql in _MEMBER_SQL.items())}
  FROM (SELECT c_custkey AS id, c_nationkey AS n FROM customer WHERE c_custkey % 3 <> 0)
  UNION ALL
  SELECT -id, 'S' || id, 'First' || n, NULL, 'Last' || id % 100000, NULL, NULL, NULL, {', '.join('NULL' for _ in _MEMBER_SQL)}
  FROM (SELECT c_custkey AS id, c_nationkey AS n FROM customer WHERE c_custkey % 30 = 10)
)"""


def members(t: Tables) -> DataFrame:
    base = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n"))
    i, n = F.col("id"), F.col("n")
    text = lambda c: c.cast("string")
    join = lambda *parts: F.concat(*[text(p) if isinstance(p, Column) else F.lit(p) for p in parts])
    unless = lambda gone, value: F.when(~gone, value)
    last = F.col("id") % 100_000
    full = {
        "student_id": join("S", i), "first_name": F.when(n % 5 == 4, "Имя").otherwise(join("first", n)), "middle_name": F.when(i % 2 == 0, "Mid"),
        "last_name": join(" LAST", last), "first_name_translated": F.when(n % 5 > 2, join("FIRST", n)), "middle_name_translated": F.lit(None).cast("string"),
        "last_name_translated": join("last", last),
        "type_of_learning": unless(n % 4 == 1, join("form-", n % 3)), "academic_level": join("v9-", (i * 12) % 89), "faculty": unless(i % 6 == 1, join("faculty-", n % 7)),
        "faculty_translated": unless(i % 4 == 1, join("Faculty ", n % 7)), "email": F.when(i % 8 < 4, join("u", i, "@x")).otherwise(join("m", i, "@y")),
        "date_of_birth": F.when(i % 3 == 1, join("1999-06-0", 1 + i % 9, "T00:00")).otherwise("06/1999"), "phone_number": unless(i % 5 == 1, join("+7", i)),
        "image": unless(i % 2 == 0, join("http://p/", i)), "rzd_status": unless(i % 5 == 2, F.lit("sent")), "rzd_number": F.when(i % 7 == 2, " ").otherwise(join("R", i)),
        "rzd_datetime": unless(i % 11 == 2, join("2024-01-1", i % 9)), "status": unless(i % 4 == 2, join("member", n % 2)),
        "status_gain_date": F.when(i % 9 == 4, None).when(i % 9 == 5, "").otherwise(join("2023-0", 1 + i % 9, "-01")),
        "card_id": unless(i % 10 == 4, i * 7), "card_status": F.when(i % 2 == 1, "ok").otherwise("lost"), "card_date": join("2024-02-0", 1 + i % 9),
        "card_number": i * 11, "card_user": F.when(i % 12 == 5, "").otherwise(join("holder ", i)),
    }
    records = base.filter(i % 3 != 0).select("id", *[c.alias(name) for name, c in full.items()])
    bare = {"student_id": join("S", i), "first_name": join("First", n), "last_name": join("Last", last)}
    again = base.filter(i % 30 == 10).select((-i).alias("id"), *[bare.get(name, F.lit(None)).cast(records.schema[name].dataType).alias(name) for name in full])
    return records.unionByName(again)


def _combined_sql() -> str:
    """The resolved person table in SQL, attribute by attribute."""
    name_of = {v: k for k, v in PERSON_PARAMS.items()}
    picks = ", ".join(f'{_pick_sql(PARAMS.index(p))} AS "{c}", {_pick_sql(PARAMS.index(p), "source")} AS "{c}_source"' for c, p in name_of.items())
    um = {"education_form": "type_of_learning", "education_level": "academic_level", "photo": "image", "birthday": "date_of_birth", "faculty_eng": "faculty_translated"}
    out = ["u.user_id"]
    for c in USER_ONLY:
        out += [f'u."{c}"', f'u."{c}_source"']
    both = lambda a, b: f"CASE WHEN {a} <> {b} THEN {a} || ', ' || {b} ELSE coalesce({a}, {b}) END"
    for c in SHARED:
        a, b = f"m.{um.get(c, c)}", f'u."{c}"'
        out += [f"{both(a, b)} AS {c}", f"CASE WHEN {a} <> {b} THEN '{MEMBER_SOURCE}, ' || coalesce({b[:-1]}_source\", '') WHEN {a} IS NOT NULL THEN '{MEMBER_SOURCE}' WHEN {b} IS NOT NULL THEN {b[:-1]}_source\" END AS {c}_source"]
    dotted, dashed = r"regexp_full_match(u.birthday, '\d{2}\.\d{2}\.\d{4}')", r"regexp_matches(m.date_of_birth, '^\d{4}-\d{2}-\d{2}')"
    other = "len(list_filter(u.full_names, lambda x: x <> m.full_name)) > 0"
    known = lambda c, *needs: f"CASE WHEN {' AND '.join(f'm.{x} IS NOT NULL' for x in needs)} THEN {c} END"
    status, rzd = ("status", "status_gain_date"), ("rzd_number", "rzd_status")
    out += [
        f"{both('m.faculty_translated', 'u.faculty')} AS faculty_eng",
        f"CASE WHEN {dotted} THEN u.birthday WHEN {dashed} THEN m.date_of_birth END AS birthday",
        f"CASE WHEN {dashed} THEN '{MEMBER_SOURCE}' WHEN {dotted} THEN u.birthday_source END AS birthday_source",
        f"CASE WHEN {other} THEN array_to_string(u.full_names, ', ') || ', ' || m.full_name ELSE m.full_name END AS full_name",
        f"CASE WHEN {other} THEN '{MEMBER_SOURCE}, ' || u.full_name_source ELSE '{MEMBER_SOURCE}' END AS full_name_source",
        "m.full_name_eng", "u.student_id", f"coalesce(u.student_id_source, '{MEMBER_SOURCE}') AS student_id_source",
        f"{known('m.status', *status)} AS status", f"{known(chr(39) + MEMBER_SOURCE + chr(39), *status)} AS status_source", f"{known('m.status_gain_date', *status)} AS status_gain_date",
        f"{known('m.rzd_number', *rzd)} AS rzd_number", f"{known(chr(39) + MEMBER_SOURCE + chr(39), *rzd)} AS rzd_number_source",
        f"{known('m.rzd_status', *rzd)} AS rzd_status", f"{known('m.rzd_datetime', *rzd)} AS rzd_datetime",
        *[f"CAST(m.{c} AS VARCHAR) AS {c}" for c in ("card_id", "card_status", "card_date", "card_number", "card_user")],
    ]
    full = " + ".join(f"CASE WHEN trim(\"{c}\") <> '' THEN 1 ELSE 0 END" for c in COMPLETENESS)
    match = " OR ".join(f"(list_contains(u.{a}, lower(trim(m.first_name{s}))) AND list_contains(u.{b}, lower(trim(m.last_name{s}))))" for s in ("", "_translated") for a, b in (("w1", "w2"), ("w2", "w1"), ("t1", "t3")))
    return f"""{_FACTS_SQL}, {_MEMBERS_SQL}, spelled AS (
  SELECT *, concat_ws(' ', first_name, middle_name, last_name) AS full_name, concat_ws(' ', first_name_translated, middle_name_translated, last_name_translated) AS full_name_eng FROM members
), worded AS (
  SELECT user_id, value AS name, string_split(trim(regexp_replace(lower(value), '\\s+', ' ', 'g')), ' ') AS w FROM facts WHERE i = {NAME}
), sets AS (
  SELECT user_id, list_sort(list(DISTINCT name)) AS full_names, list(DISTINCT w[1]) FILTER (len(w) >= 2) AS w1, list(DISTINCT w[2]) FILTER (len(w) >= 2) AS w2,
         list(DISTINCT w[1]) FILTER (len(w) = 3) AS t1, list(DISTINCT w[3]) FILTER (len(w) = 3) AS t3 FROM worded GROUP BY user_id
), users AS (
  SELECT * FROM (SELECT user_id, {picks} FROM facts GROUP BY user_id) LEFT JOIN sets USING (user_id)
), matched AS (
  SELECT {', '.join(out)} FROM users u JOIN spelled m ON trim(u.student_id) <> '' AND u.student_id = m.student_id AND ({match})
), combined AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {full} DESC, full_name NULLS FIRST, card_id NULLS FIRST, email NULLS FIRST) AS place FROM matched) WHERE place = 1
)"""


COMBINED_SQL = _combined_sql()


def combined(t: Tables) -> DataFrame:
    return combine(user_table(person_facts(*profile(t))), member_table(members(t)))


@query("person_combined", COMBINED_SQL + " SELECT * FROM combined")
def _(t: Tables) -> DataFrame:
    return combined(t)


# --- attribute tables: an earlier run knew the users with even ids, and values that are gone by now

_EARLIER, _NOW, _LONG_AGO = "2024-01-01", "2024-02-01", "2020-01-01"


def _offers_sql(spec: Satellite) -> str:
    source = f"'{MEMBER_SOURCE}'" if spec.source is None else f'"{spec.source}"'
    guards = [f'"{c}" IS NOT NULL' if column in spec.may_be_blank else f"trim(\"{c}\") <> ''" for column, c in spec.values.items()]
    guards += [f"trim({source}) <> ''"] + (["trim(student_id) <> ''"] if spec.needs_student else [])
    values = ", ".join(f'"{c}" AS v{k}' for k, c in enumerate(spec.values.values()))
    return f"SELECT user_id, {values}, {source} AS source FROM combined WHERE {' AND '.join(guards)}"


def _satellite_sql(spec: Satellite) -> str:
    """Rows (user_id, v0 ..., source, created, modified, is_deleted) of one attribute table after the run."""
    values = ", ".join(f"v{k}" for k in range(len(spec.values)))
    gone = ", ".join(f"'gone' AS v{k}" for k in range(len(spec.values)))
    return f"""SELECT user_id, {values}, source, CASE WHEN user_id % 2 = 0 THEN '{_EARLIER}' ELSE '{_NOW}' END AS created, '{_NOW}' AS modified, false AS is_deleted FROM ({_offers_sql(spec)})
UNION ALL SELECT user_id, {gone}, 'user', '{_LONG_AGO}', '{_LONG_AGO}', true FROM combined WHERE user_id % 5 = 0"""


def satellites(t: Tables, specs: list[Satellite]) -> dict[str, DataFrame]:
    people = materialize(combined(t))
    ago = F.lit(_LONG_AGO).cast("timestamp")
    stored = {}
    for spec in specs:
        earlier = satellite_rows(people.filter("user_id % 2 = 0"), spec, _EARLIER)
        gone = people.filter("user_id % 5 = 0").select(*[F.lit("gone").alias(c) for c in spec.values], F.col("user_id").cast("int").alias("user_id"), F.lit("user").alias("source"), ago.alias("created"), ago.alias("modified"), F.lit(True).alias("is_deleted"))
        stored[spec.table] = earlier.unionByName(gone)
    return merge_satellites(stored, people, _NOW, specs)


def _spec(name: str) -> Satellite:
    return next(s for s in SATELLITES if s.table == name)


_ALL_SQL = " UNION ALL ".join(f"SELECT '{s.table}' AS satellite, user_id, concat_ws('|', {', '.join(f'v{k}' for k in range(len(s.values)))}) AS content, source, created, modified, is_deleted FROM ({_satellite_sql(s)})" for s in SATELLITES)


@query("satellites_refresh", f"{COMBINED_SQL} {_ALL_SQL}")
def _(t: Tables) -> DataFrame:
    """All 28 attribute tables after one merge, stacked to be compared."""
    out = None
    for name, table in satellites(t, SATELLITES).items():
        shown = table.select(F.lit(name).alias("satellite"), F.col("user_id").cast("bigint").alias("user_id"), F.concat_ws("|", *_spec(name).values).alias("content"), "source", day("created").alias("created"), day("modified").alias("modified"), "is_deleted")
        out = shown if out is None else out.unionByName(shown)
    return out


def _register(name: str) -> None:
    spec = _spec(name)
    columns = ", ".join(f'v{k} AS "{c}"' for k, c in enumerate(spec.values))

    @query(f"satellite_{name}", f"{COMBINED_SQL} SELECT {columns}, user_id, source, created, modified, is_deleted FROM ({_satellite_sql(spec)})")
    def _(t: Tables) -> DataFrame:
        table = satellites(t, [spec])[name]
        return table.withColumns({c: day(c) for c in ("created", "modified")}).withColumn("user_id", F.col("user_id").cast("bigint"))


for _name in ("birthday", "faculty_eng", "full_name_eng", "student_id", "status", "rzd", "card"):
    _register(_name)

"""Person resolution: profile facts and member records to one row, then one table per attribute."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.functions.columns import Col, as_col, is_blank, keep_if, survive, survive_source
from sedimart.functions.fixed import MEMBER_BIRTHDAY, MEMBER_SOURCE, NAME_PARAM, PERSON_PARAMS, PROFILE_BIRTHDAY
from sedimart.operators.aggregates import eav_pivot, sorted_set
from sedimart.operators.merge import upsert
from sedimart.operators.ranking import completeness_dedupe
from sedimart.session import deal, stage


def name_words(col: Col) -> Column:
    """Lower-case words of a name, runs of white space read as one space."""
    return F.split(F.trim(F.regexp_replace(F.lower(as_col(col)), r"\s+", " ")), " ")


def name_parts(df: DataFrame, owner: str, col: str, rows: int | None = None) -> DataFrame:
    """Per owner the sets of words at the places a first or last name can have.

    ``w1`` and ``w2`` come from names of two words or more, ``t1`` and ``t3`` from names of three.
    Names are dealt out before any are gathered, to as many tasks as ``rows``, else their count, asks for.
    """
    rows = df.count() if rows is None else rows
    named = df.select(owner, F.col(col).alias("__name"))
    distinct = deal(named, rows, *named.columns).distinct()
    worded = deal(distinct, rows, owner).withColumn("__w", name_words("__name"))
    many, three = F.size("__w") >= 2, F.size("__w") == 3
    word = lambda i: F.get("__w", F.lit(i - 1))
    return worded.groupBy(owner).agg(
        sorted_set(F.col("__name").isNotNull(), F.col("__name")).alias("full_names"),
        sorted_set(many, word(1)).alias("w1"),
        sorted_set(many, word(2)).alias("w2"),
        sorted_set(three, word(1)).alias("t1"),
        sorted_set(three, word(3)).alias("t3"),
    )


def names_agree(first: Col, last: Col) -> Column:
    """First and last name both occur, in any of the three orders: First Last, Last First
    [Middle], First Middle Last.  The two are looked up independently of each other."""
    f, l = F.lower(F.trim(as_col(first))), F.lower(F.trim(as_col(last)))
    orders = [("w1", "w2"), ("w2", "w1"), ("t1", "t3")]
    found = reduce(
        lambda a, b: a | b, [F.array_contains(x, f) & F.array_contains(y, l) for x, y in orders]
    )
    return F.coalesce((f != "") & (l != "") & found, F.lit(False))


def resolve_person(users: DataFrame, members: DataFrame, id_col: str = "student_id") -> DataFrame:
    """Users joined with the member that has the same non-blank id and an agreeing name.

    ``users`` carries the sets of ``name_parts``; member columns come out as ``um_<name>``.
    """
    side = members.filter(~is_blank(id_col)).withColumnsRenamed({c: f"um_{c}" for c in members.columns})
    live = users.filter(~is_blank(id_col))
    native = names_agree("um_first_name", "um_last_name")
    translated = names_agree("um_first_name_translated", "um_last_name_translated")
    return live.join(side, (F.col(id_col) == F.col(f"um_{id_col}")) & (native | translated))


def person_facts(info: DataFrame, param: DataFrame, source: DataFrame) -> DataFrame:
    """(owner_id, name, value, source): profile facts with their names; facts without source drop.

    The lists of attributes and sources are sent to the facts, which stay where they are read: Spark may
    not know how short the lists are, nor how many facts there will be, and must not send the facts to them.
    """
    names = param.select(F.col("id").alias("param_id"), F.col("name"))
    sources = source.select(F.col("id").alias("source_id"), F.col("name").alias("source"))
    named = info.join(F.broadcast(sources), "source_id").join(F.broadcast(names), "param_id", "left")
    return named.select("owner_id", "name", "value", "source")


def user_table(facts: DataFrame) -> DataFrame:
    """One row per user: attributes, their sources, and the name sets, dealt out alike by the number of facts."""
    rows = facts.count()
    wide = eav_pivot(facts, "owner_id", "name", "value", PERSON_PARAMS, "source", rows=rows)
    named = name_parts(facts.filter(F.col("name") == NAME_PARAM), "owner_id", "value", rows)
    return wide.join(named, "owner_id", "left").withColumnRenamed("owner_id", "user_id")


def member_table(members: DataFrame) -> DataFrame:
    """Member records under the attribute names of the user table."""
    renamed = members.withColumnsRenamed(
        {
            "type_of_learning": "education_form",
            "academic_level": "education_level",
            "faculty_translated": "faculty_eng",
            "date_of_birth": "birthday",
            "image": "photo",
        }
    )
    joined_name = lambda suffix: F.concat_ws(
        " ", f"first_name{suffix}", f"middle_name{suffix}", f"last_name{suffix}"
    )
    card = [c for c in members.columns if c.startswith("card_")]
    return (
        renamed.withColumns({c: F.col(c).cast("string") for c in card})
        .withColumn("full_name", joined_name(""))
        .withColumn("full_name_eng", joined_name("_translated"))
        .withColumn("source", F.lit(MEMBER_SOURCE))
        .drop("id")
    )


# Attributes that only the profile knows.
USER_ONLY = [
    "academic_group", "address", "birth_city", "city", "department", "git_hub_username", "home_phone_number",
    "position", "sex", "telegram_username", "university", "vk_username", "workplace", "workplace_address",
]
# Attributes that both sides may know.
SHARED = ["education_form", "education_level", "email", "faculty", "phone_number", "photo"]

# Attributes that count towards the fullness of a match.
COMPLETENESS = [
    *USER_ONLY, *SHARED, "faculty_eng", "full_name", "full_name_eng", "student_id", "status", "rzd_number",
    "card_id", "card_status", "card_date", "card_number", "card_user",
]


def combine(users: DataFrame, members: DataFrame) -> DataFrame:
    """The resolved person table: one row per matched user, the fullest match first.

    A birthday's value prefers the profile, its source the member record; the English faculty
    is weighed against the profile's native one.  Both as the warehouse has it.
    """
    um = lambda c: F.col(f"um_{c}")
    matched = resolve_person(users, members)
    out: dict[str, Column] = {"user_id": F.col("user_id")}
    for c in USER_ONLY:
        out[c], out[f"{c}_source"] = F.col(c), F.col(f"{c}_source")
    for c in SHARED:
        out[c] = survive(um(c), c)
        out[f"{c}_source"] = survive_source(um(c), c, um("source"), f"{c}_source")
    out["faculty_eng"] = survive(um("faculty_eng"), "faculty")

    dotted = F.col("birthday").rlike(PROFILE_BIRTHDAY)
    dashed = um("birthday").rlike(MEMBER_BIRTHDAY)
    out["birthday"] = F.when(dotted, F.col("birthday")).otherwise(F.when(dashed, um("birthday")))
    out["birthday_source"] = F.when(dashed, um("source")).when(dotted, F.col("birthday_source"))

    other_name = F.exists("full_names", lambda x: x != um("full_name"))
    out["full_name"] = F.when(
        other_name, F.concat_ws(", ", F.array_join("full_names", ", "), um("full_name"))
    ).otherwise(um("full_name"))
    out["full_name_source"] = F.when(
        other_name, F.concat(um("source"), F.lit(", "), F.coalesce("full_name_source", F.lit("")))
    ).otherwise(um("source"))
    out["full_name_eng"] = um("full_name_eng")
    out["student_id"] = F.col("student_id")
    out["student_id_source"] = F.coalesce("student_id_source", um("source"))

    for c in ("status", "source", "status_gain_date"):
        name = "status_source" if c == "source" else c
        out[name] = keep_if(um(c), um("status"), um("status_gain_date"))
    for c in ("rzd_number", "source", "rzd_status", "rzd_datetime"):
        name = "rzd_number_source" if c == "source" else c
        out[name] = keep_if(um(c), um("rzd_number"), um("rzd_status"))
    for c in ("card_id", "card_status", "card_date", "card_number", "card_user"):
        out[c] = um(c)

    combined = matched.select(*[v.alias(k) for k, v in out.items()])
    tie = [F.col(c) for c in ("full_name", "card_id", "email")]
    return completeness_dedupe(combined, "user_id", COMPLETENESS, tie).drop("completeness_score")


@dataclass(frozen=True)
class Satellite:
    """One attribute table: its value columns (column -> combined column), key and source."""

    table: str
    values: dict[str, str]
    source: str | None = None  # combined column; None: the constant member source
    keys: list[str] = field(default_factory=list)
    may_be_blank: frozenset[str] = frozenset()  # values that must be known, but may be blank
    needs_student: bool = True

    @property
    def conflict(self) -> list[str]:
        return self.keys or ["user_id", next(iter(self.values))]

    @property
    def value_key(self) -> str:
        """The value column that, with the user, tells rows apart."""
        return next(c for c in self.conflict if c != "user_id")


def _plain(table: str, column: str, attr: str | None = None, source: str | None = "") -> Satellite:
    attr = attr or table
    return Satellite(table, {column: attr}, f"{attr}_source" if source == "" else source)


# The attribute tables with their columns and sources.
SATELLITES = [
    _plain("academic_group", "group"),
    _plain("address", "address"),
    _plain("birth_city", "city"),
    Satellite("birthday", {"birthday": "birthday"}, "birthday_source", may_be_blank=frozenset({"birthday"})),
    _plain("city", "city"),
    _plain("department", "department"),
    _plain("education_form", "form"),
    _plain("education_level", "level"),
    _plain("email", "email"),
    _plain("faculty", "faculty"),
    _plain("faculty_eng", "faculty_eng", source="faculty_source"),
    _plain("full_name", "name"),
    _plain("full_name_eng", "name", source=None),
    _plain("git_hub_username", "username"),
    _plain("home_phone_number", "phone_number"),
    _plain("phone_number", "phone_number"),
    _plain("photo", "url"),
    _plain("position", "position"),
    _plain("sex", "gender"),
    Satellite("student_id", {"student_id": "student_id"}, "student_id_source", needs_student=False),
    _plain("telegram_username", "username"),
    _plain("university", "university"),
    _plain("vk_username", "username"),
    _plain("workplace", "workplace"),
    _plain("workplace_address", "address"),
    Satellite(
        "status",
        {"status": "status", "status_gain_date": "status_gain_date"},
        "status_source",
        may_be_blank=frozenset({"status_gain_date"}),
    ),
    Satellite(
        "rzd",
        {"rzd_number": "rzd_number", "rzd_status": "rzd_status", "rzd_datetime": "rzd_datetime"},
        "rzd_number_source",
        may_be_blank=frozenset({"rzd_datetime"}),
    ),
    Satellite(
        "card",
        {c: c for c in ("card_id", "card_status", "card_date", "card_number", "card_user")},
        None,
        keys=["card_id", "user_id"],
    ),
]


def _offered(spec: Satellite) -> Column:
    """Whether a row of the combined table has something for an attribute table."""
    guards = [F.col(c).isNotNull() if column in spec.may_be_blank else ~is_blank(c) for column, c in spec.values.items()]
    guards.append(~is_blank(_source_of(spec)))
    if spec.needs_student:
        guards.append(~is_blank("student_id"))
    return reduce(lambda a, b: a & b, guards)


def _source_of(spec: Satellite) -> Column:
    return F.lit(MEMBER_SOURCE) if spec.source is None else F.col(spec.source)


def satellite_rows(combined: DataFrame, spec: Satellite, as_of: str) -> DataFrame:
    """Rows that the combined table offers to one attribute table."""
    now = F.lit(as_of).cast("timestamp")
    values = [F.col(c).alias(column) for column, c in spec.values.items()]
    rows = combined.filter(_offered(spec)).select(*values, F.col("user_id").cast("int").alias("user_id"), _source_of(spec).alias("source"))
    return rows.distinct().withColumns({"created": now, "modified": now, "is_deleted": F.lit(False)})


def change_set(combined: DataFrame, specs: Sequence[Satellite], as_of: str, rows: int | None = None) -> DataFrame:
    """(satellite, user_id, key, values, source, created, modified, is_deleted) for all attribute tables, in one pass.

    ``key`` is the value that, with the user, tells rows of a table apart; ``values`` maps the table's
    columns to their values as text. Persons are dealt out by ``rows``, about how many offers they make,
    before these are made, so that equal ones meet without another shuffle.
    """
    rows = combined.count() * len(specs) if rows is None else rows
    now = F.lit(as_of).cast("timestamp")
    offers = []
    for spec in specs:
        values = F.create_map(*[x for column, c in spec.values.items() for x in (F.lit(column), F.col(c).cast("string"))])
        row = F.struct(F.lit(spec.table).alias("satellite"), F.col(spec.values[spec.value_key]).cast("string").alias("key"), values.alias("values"), _source_of(spec).alias("source"))
        offers.append(F.when(_offered(spec), row))
    dealt = deal(combined.withColumn("user_id", F.col("user_id").cast("int")), rows, "user_id")
    opened = dealt.select("user_id", F.explode(F.array_compact(F.array(*offers))).alias("o"))
    offers = opened.select("o.satellite", "user_id", "o.key", "o.values", "o.source")
    # equal offers are one; maps are compared as their sorted entries
    alike = ["satellite", "user_id", "key", "source", "__entries"]
    offers = offers.withColumn("__entries", F.array_sort(F.map_entries("values"))).dropDuplicates(alike).drop("__entries")
    return offers.withColumns({"created": now, "modified": now, "is_deleted": F.lit(False)})


def as_long(table: DataFrame, spec: Satellite) -> DataFrame:
    """An attribute table in the form of the change set."""
    values = F.create_map(*[x for c in spec.values for x in (F.lit(c), F.col(c).cast("string"))])
    return table.select(
        F.lit(spec.table).alias("satellite"), F.col("user_id").cast("int").alias("user_id"), F.col(spec.value_key).cast("string").alias("key"),
        values.alias("values"), "source", F.col("created").cast("timestamp").alias("created"), F.col("modified").cast("timestamp").alias("modified"), "is_deleted",
    )


def merge_satellites(stored: dict[str, DataFrame], combined: DataFrame, as_of: str, specs: Sequence[Satellite]) -> dict[str, DataFrame]:
    """All attribute tables after the run, out of one merge.

    The tables are put together in long form, meet one change set in one upsert, and are told apart
    again as they are written, each into a folder of its own; the tables handed back read theirs alone,
    with the types they came with. The tasks follow the number of rows that the persons may offer, and
    as many again for what is stored.
    """
    tables = [s for s in specs if s.table in stored]
    rows = combined.count() * len(tables)
    long = reduce(DataFrame.unionByName, [as_long(stored[s.table], s) for s in tables])
    merged = upsert(long, change_set(combined, tables, as_of, rows), ["satellite", "user_id", "key"], ["values", "source", "modified"], rows=2 * rows)
    written = stage(merged, "satellites", "satellite")
    out = {}
    for spec in tables:
        mine = written.filter(F.col("satellite") == spec.table)
        kinds = {f.name: f.dataType for f in stored[spec.table].schema.fields}
        column = lambda c, spec=spec: F.col("values")[c] if c in spec.values else F.col(c)
        out[spec.table] = mine.select(*[column(c).cast(kinds[c]).alias(c) for c in stored[spec.table].columns])
    return out


def satellite_upsert(target: DataFrame, combined: DataFrame, spec: Satellite, as_of: str) -> DataFrame:
    """Attribute table after the run: known values refreshed, new ones added."""
    set_cols = [*spec.values, "source", "modified"]
    return upsert(target, satellite_rows(combined, spec, as_of), spec.conflict, set_cols)


def resolve_ids(
    df: DataFrame, row_id: str, array_col: str, dim: DataFrame, name_col: str, id_col: str, unknown: int | None
) -> tuple[DataFrame, DataFrame]:
    """Names in an array replaced by ids, order kept; and the names the dimension lacks.

    The smallest id stands for a repeated name.  Unknown names become ``unknown`` (NULL: none).
    """
    ids = dim.groupBy(F.col(name_col).alias("__name")).agg(F.min(id_col).alias("__id"))
    opened = df.select(row_id, F.posexplode(array_col).alias("__pos", "__name"))
    met = opened.join(ids, "__name", "left")
    fill = F.coalesce("__id", F.lit(unknown)) if unknown is not None else F.col("__id")
    back = met.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("__pos", fill.alias("__id")))).alias("__ids"))
    ids_array = F.transform("__ids", lambda x: x["__id"])
    out = df.join(back, row_id, "left").withColumn(
        array_col, F.when(F.size(array_col) == 0, F.array()).otherwise(ids_array)
    )
    to_create = met.filter(F.col("__id").isNull()).select(F.col("__name").alias(name_col)).distinct()
    return out.drop("__ids"), to_create


def created_id(key: Col) -> Column:
    """The id of a dimension row that a run creates: positive, and the same whenever its key is met again."""
    return F.xxhash64(as_col(key)).bitwiseAND(F.lit((1 << 63) - 1))


def resolve_or_create(
    df: DataFrame, row_id: str, array_col: str, dim: DataFrame, dim_key: Column, id_col: str,
    name_key: Callable[[Column], Column], new_row: Callable[[Column], dict[str, Column]],
) -> tuple[DataFrame, DataFrame]:
    """(rows with ids for the names in an array, order kept; the dimension rows created for unknown names).

    First every name is brought to its key, and keys that the dimension lacks become rows of it, of the
    columns that ``new_row`` makes of the smallest name; their ids follow from the key, so a rerun makes
    the same ones. Then all names are looked up in both. The smallest id stands for a repeated key; a
    NULL name or key gets no id and creates nothing.
    """
    known = dim.groupBy(dim_key.alias("__key")).agg(F.min(id_col).cast("bigint").alias("__id")).filter("__key is not null")
    opened = df.select(row_id, F.posexplode(array_col).alias("__pos", "__name")).withColumn("__key", name_key(F.col("__name")))
    wanted = opened.filter("__key is not null").groupBy("__key").agg(F.min("__name").alias("__name"))
    fresh = stage(wanted.join(known, "__key", "left_anti").withColumn("__id", created_id("__key")), "created")
    met = opened.join(known.unionByName(fresh.drop("__name")), "__key", "left")
    back = met.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("__pos", "__id"))).alias("__ids"))
    ids = F.transform("__ids", lambda x: x["__id"])
    out = df.join(back, row_id, "left").withColumn(array_col, F.when(F.size(array_col) == 0, F.array()).otherwise(ids)).drop("__ids")
    columns = new_row(F.col("__name")) | {id_col: F.col("__id")}
    created = fresh.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dim.schema.fields])
    return out, created


def lecturer_key(last: Col, first: Col, middle: Col) -> Column:
    """'Last F M': what a timetable entry shows of a lecturer."""
    initial = lambda c: F.left(as_col(c), F.lit(1))
    return F.concat_ws(" ", as_col(last), initial(first), initial(middle))


def lecturer_key_of_text(text: Col) -> Column:
    """The same key from 'Last First Middle' or 'Last F. M.' text."""
    parts = F.split(F.trim(as_col(text)), r"\s+")
    return lecturer_key(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))

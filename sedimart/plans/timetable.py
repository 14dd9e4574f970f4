"""Timetable: dimensions, links and the joined mart, plus the flattened lesson documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.columns import stable_id
from sedimart.functions.fixed import NEW_GROUP_NAME, NEW_LECTURER_DESCRIPTION, UNKNOWN_ROOM
from sedimart.operators.aggregates import dim_dedupe
from sedimart.operators.linking import link_best
from sedimart.operators.payloads import flatten_two_arrays
from sedimart.operators.people import lecturer_key, lecturer_key_of_text, resolve_ids, resolve_or_create


def dim_event(raw: DataFrame, source_name: str) -> DataFrame:
    dim = dim_dedupe(raw, {"event_name_text": F.col("name")}, "id", "event_api_id")
    return _stamped(dim, ["event_name_text"], source_name)


def dim_group(raw: DataFrame, source_name: str) -> DataFrame:
    natural = {"group_name_text": F.concat("number", "name"), "group_number": F.col("number")}
    return _stamped(dim_dedupe(raw, natural, "id", "group_api_id"), list(natural), source_name)


def dim_room(raw: DataFrame, source_name: str) -> DataFrame:
    natural = {
        "room_name": F.col("name"),
        "room_department": F.col("building"),
        "room_direction_text_type": F.col("direction"),
    }
    return _stamped(dim_dedupe(raw, natural, "id", "room_api_id"), list(natural), source_name)


def dim_lecturer(raw: DataFrame, source_name: str) -> DataFrame:
    natural = {f"lecturer_{c}": F.col(c) for c in ("first_name", "middle_name", "last_name")}
    extra = {"avatar_id": "lecturer_avatar_id", "description": "lecturer_description"}
    return _stamped(dim_dedupe(raw, natural, "id", "lecturer_api_id", extra), list(natural), source_name)


def _stamped(dim: DataFrame, natural: list[str], source_name: str) -> DataFrame:
    return dim.withColumn("id", stable_id(F.lit(source_name), *natural)).withColumn("source_name", F.lit(source_name))


def link_table(events: DataFrame, dim: DataFrame, name_col: str, out: str, contains: bool = True) -> DataFrame:
    """(id, event_id, <out>): the dimension row that fits each event best.

    Lessons are linked without the containment test: an event without any match gets the
    smallest dimension id.
    """
    side = dim.select(F.col("id").alias(out), F.col(name_col).alias("__dim_name"))
    linked = link_best(
        events.select(F.col("id").alias("event_id"), F.col("name").alias("__event_name")),
        side, "event_id", "__event_name", out, "__dim_name", contains, default_unmatched=not contains,
    )
    return linked.select(stable_id("event_id", out).alias("id"), "event_id", out)


def gathered_links(links: dict[str, DataFrame]) -> DataFrame:
    """One row per event with the value of each link (event_id, value), by the links' names.

    The links are put together and aggregated by event once, so the events meet them in one join.
    They are shuffled as they are: an event has few, and a row of sums would be wider than all of them.
    Exact repeats of a link are one; two values of one link for an event are an error.
    """
    # one column holds the values of all links, if they are of one type
    alike = len({df.schema["value"].dataType for df in links.values()}) == 1
    column = {name: "__value" if alike else "__value" + name for name in links}
    sides = [df.select(F.col("event_id").alias("__event"), F.lit(i).cast("byte").alias("__which"), F.col("value").alias(column[name])) for i, (name, df) in enumerate(links.items())]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides).filter("__event is not null")
    grouped = both.repartition("__event").groupBy("__event").agg(*[f(F.when(F.col("__which") == i, F.col(column[name]))).alias(p + name) for i, name in enumerate(links) for p, f in (("", F.min), ("__last", F.max))])
    one = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col("__last" + name)) for name in links])
    message = F.concat(F.lit("links repeat event "), F.col("__event").cast("string"))
    checked = grouped.filter(F.when(one, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select("__event", *links)


def timetable_mart(
    events: DataFrame,
    link_group: DataFrame,
    groups: DataFrame,
    link_lesson: DataFrame,
    lessons: DataFrame,
    link_room: DataFrame,
    rooms: DataFrame,
    link_lecturer: DataFrame,
    lecturers: DataFrame,
    source_name: str,
) -> DataFrame:
    """Events with the names of their group, lesson, room and lecturer."""
    mine = lambda dim: dim.filter(F.col("source_name") == source_name)
    key = lambda df, c: df.select("event_id", F.col(c).alias("value"))
    group = mine(groups).select(F.col("id").alias("__gid"), "group_name_text")
    lesson = mine(lessons).select(F.col("id").alias("__lid"), "event_name_text")
    room = mine(rooms).select(F.col("id").alias("__rid"), "room_name")
    full = F.concat_ws(" ", "lecturer_first_name", "lecturer_middle_name", "lecturer_last_name")
    any_null = F.col("lecturer_first_name").isNull() | F.col("lecturer_middle_name").isNull() | F.col("lecturer_last_name").isNull()
    lecturer = mine(lecturers).select(F.col("id").alias("__tid"), F.when(~any_null, full).alias("lecturer_name"))
    return (
        events.join(gathered_links({"__g": key(link_group, "group_id"), "__l": key(link_lesson, "lesson_id"), "__r": key(link_room, "room_id"), "__t": key(link_lecturer, "teacher_id")}), F.col("id") == F.col("__event"), "left")
        # the longest names come last: a join shuffles what the ones before have added
        .join(lesson, F.col("__l") == F.col("__lid"), "left")
        .join(room, F.col("__r") == F.col("__rid"), "left")
        .join(group, F.col("__g") == F.col("__gid"), "left")
        .join(lecturer, F.col("__t") == F.col("__tid"), "left")
        .select(
            F.col("id").alias("event_id"),
            "name",
            "odd",
            "even",
            "weekday",
            "num",
            "start",
            "end",
            "group",
            F.col("group_name_text").alias("group_name"),
            F.col("event_name_text").alias("event_name"),
            "room_name",
            "lecturer_name",
        )
    )


def lessons_to_ids(lessons: DataFrame, rooms: DataFrame, groups: DataFrame, lecturers: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Lessons (id, place, group, teacher ...) with ids in place of names, and what the tables lack.

    Unknown rooms get the id of no room and are reported; unknown groups and lecturers become rows of
    their tables in the same run, whose ids the lessons then carry. A lecturer is told by last name and
    initials, and the first letters stand for the names of a created one.
    """
    placed, no_rooms = resolve_ids(lessons, "id", "place", rooms, "name", "id", UNKNOWN_ROOM)
    number = lambda name: {"number": name, "name": F.concat(F.lit(NEW_GROUP_NAME), name)}
    grouped, new_groups = resolve_or_create(placed, "id", "group", groups, F.col("number"), "id", lambda name: name, number)
    parts = lambda name, i: F.get(F.split(F.trim(name), r"\s+"), F.lit(i))
    person = lambda name: {
        "last_name": parts(name, 0), "first_name": F.left(parts(name, 1), F.lit(1)), "middle_name": F.left(parts(name, 2), F.lit(1)), "description": F.lit(NEW_LECTURER_DESCRIPTION),
    }
    key = lecturer_key("last_name", "first_name", "middle_name")
    taught, new_lecturers = resolve_or_create(grouped, "id", "teacher", lecturers, key, "id", lecturer_key_of_text, person)
    return taught, {"rooms": no_rooms, "groups": new_groups, "lecturers": new_lecturers}


def flattened_lessons(raw: DataFrame) -> DataFrame:
    """Lesson rows per teacher and study group.

    A missing part of the teacher's name leaves the whole name unknown, a JSON null in it reads
    ``null``; the group's name keeps its JSON quotes, both as in the warehouse.
    """
    # the parts are read as JSON text, in which null is a word of its own
    as_json = lambda elem, path: F.to_json(F.variant_get(F.col(elem), f"$.{path}", "variant"))
    opened = flatten_two_arrays(raw, "teacher_users", "study_groups", "__t", "__s")
    parts = [as_json("__t", p) for p in ("sur_name", "first_name", "second_name")]
    full = F.replace(F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2]), F.lit('"'), F.lit(""))
    return opened.select(
        "group_name",
        F.col("dicscipline_name").alias("discipline_name"),
        "discipline_id",
        "classroom_name",
        "classroom_id",
        "lesson_type_text",
        "lesson_from_dttm_ts",
        "lesson_to_dttm_ts",
        full.alias("teacher_full_name"),
        F.variant_get("__s", "$.id", "int").alias("study_group_id"),
        as_json("__s", "name").alias("study_group_name"),
    )

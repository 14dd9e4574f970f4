"""Payload tables for the systems that read from the warehouse."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.columns import first_item, last_item
from sedimart.functions.fixed import (
    DIGEST_ANONYMOUS,
    DIGEST_KEEP,
    DIGEST_LIMIT,
    PRINTER_FACULTY,
    PRINTER_STATUS,
    PROFILE_ITEMS,
)
from sedimart.operators.history import scd2_current
from sedimart.operators.ranking import keep_first, latest_attribute

KEEP_NULLS = {"ignoreNullFields": "false"}


def lecturer_payload(hist: DataFrame) -> DataFrame:
    """Open lecturer versions as typed rows and as JSON text."""
    text = ["first_name", "last_name", "middle_name", "avatar_link"]
    marks = ["mark_weighted", "mark_kindness_weighted", "mark_clarity_weighted", "mark_freebie_weighted"]
    rows = scd2_current(hist).select(
        F.col("api_id").cast("int").alias("id"),
        *[F.col(c).cast("string").alias(c) for c in text],
        F.col("timetable_id").cast("int").alias("timetable_id"),
        *[F.col(c).cast("double").alias(c) for c in marks],
        F.col("rank").cast("int").alias("rank"),
    )
    return rows.withColumn("payload", F.to_json(F.struct(*rows.columns), KEEP_NULLS))


def profile_items(attrs: DataFrame, cohort: DataFrame, mapping: DataFrame) -> DataFrame:
    """Eleven (category, param, value) rows for each user of the cohort.

    ``attrs`` is the attribute tables as one: (user_id, attribute, value, created, modified,
    is_deleted).  The newest value counts, of a comma list its first item (of a full name the
    last).  An unknown value is ''; a level that ``mapping`` (code, label) lacks has no label.
    """
    newest = latest_attribute(attrs, "user_id", "attribute")
    item = F.when(F.col("attribute") == "full_name", last_item("value")).otherwise(first_item("value"))
    names = [a for _, _, a in PROFILE_ITEMS if a not in ("membership", "education_label")]
    wide = newest.groupBy("user_id").agg(
        *[F.max(F.when(F.col("attribute") == a, item)).alias(a) for a in names]
    )
    users = cohort.select("user_id").distinct().join(wide, "user_id", "left")
    filled = users.select("user_id", *[F.coalesce(a, F.lit("")).alias(a) for a in names])
    labels = mapping.groupBy(F.col("code").alias("education_level")).agg(F.min("label").alias("education_label"))
    full = filled.join(labels, "education_level", "left").withColumn("membership", F.lit("true"))
    items = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("category"), F.lit(p).alias("param"), F.col(a).alias("value"))
            for i, (c, p, a) in enumerate(PROFILE_ITEMS, 1)
        ]
    )
    return full.select("user_id", F.explode(items).alias("i")).select("user_id", "i.*")


def profile_payload(items: DataFrame, source: str = "dwh") -> DataFrame:
    """The items of a user as one JSON document."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "category", "param", "value")))
    bare = F.transform("o", lambda x: x.dropFields("position"))
    return (
        items.groupBy("user_id")
        .agg(ordered.alias("o"))
        .select("user_id", F.to_json(F.struct(bare.alias("items"), F.lit(source).alias("source")), KEEP_NULLS).alias("payload"))
    )


def membership_changes(members: DataFrame, user_groups: DataFrame, group_users: DataFrame, group_id: int) -> DataFrame:
    """New group lists: members get the group, group users who are no members lose it.

    ``user_groups`` holds (user_id, groups array); the group is added once.
    """
    gid = F.lit(group_id)
    ids = members.select("user_id").distinct()
    groups = F.coalesce("groups", F.array().cast("array<int>"))
    known = user_groups.select("user_id", "groups")
    add = ids.join(known, "user_id", "left").select(
        "user_id", F.lit("add").alias("action"), F.array_union(groups, F.array(gid)).alias("groups")
    )
    gone = group_users.select("user_id").distinct().join(ids, "user_id", "left_anti")
    remove = gone.join(known, "user_id", "left").select(
        "user_id", F.lit("remove").alias("action"), F.array_remove(groups, gid).alias("groups")
    )
    return add.unionByName(remove)


def printer_list(
    df: DataFrame, faculty: str = PRINTER_FACULTY, status: str = PRINTER_STATUS, order_by: list | None = None
) -> DataFrame:
    """Members who may print: one row per card number, the first by ``order_by``."""
    live = df.filter(
        F.contains(F.lower("faculty"), F.lit(faculty))
        & (F.lower("status") == status)
        & (F.length("last_name") > 0)
        & (F.length("card_number") > 0)
    )
    first = keep_first(live, ["card_number"], order_by or [F.col("last_name")])
    return first.select(
        F.col("last_name").alias("username"),
        F.col("card_number").alias("union_number"),
        F.lit(None).cast("string").alias("student_number"),
    )


def pending_digest(
    comments: DataFrame, lecturers: DataFrame, users: DataFrame, last_run: str, today: str
) -> tuple[DataFrame, DataFrame]:
    """Lines for the unreviewed comments since the last run, and the totals.

    On a Monday there are no lines and the total counts every unreviewed comment.
    ``comments`` holds unreviewed ones only.
    """
    monday = datetime.date.fromisoformat(today).weekday() == 0
    fresh = F.col("update_ts") >= F.lit(last_run).cast(comments.schema["update_ts"].dataType)
    initial = lambda c: F.concat(F.left(c, F.lit(1)), F.lit("."))
    teacher = lecturers.select(
        F.col("id").alias("lecturer_id"),
        F.concat("last_name", initial(F.col("first_name")), initial(F.col("middle_name"))).alias("lecturer"),
    )
    author = users.select("user_id", F.col("full_name").alias("__author"))
    cut = F.when(F.length("text") < DIGEST_LIMIT, F.col("text")).otherwise(
        F.concat(F.left("text", F.lit(DIGEST_KEEP)), F.lit("..."))
    )
    known = comments.filter(F.col("user_id").isNotNull()).join(author, "user_id", "left")
    nameless = comments.filter(F.col("user_id").isNull()).withColumn("__author", F.lit(DIGEST_ANONYMOUS))
    lines = (
        known.unionByName(nameless)
        .filter(fresh & F.lit(not monday))
        .join(teacher, "lecturer_id", "left")
        .select("uuid", "lecturer", "subject", F.col("__author").alias("author"), cut.alias("short_text"))
    )
    today_count = F.sum(F.when(fresh & F.lit(not monday), 1).otherwise(0))
    totals = comments.agg(
        F.coalesce(today_count, F.lit(0)).cast("bigint").alias("total_today"),
        F.count(F.lit(1)).cast("bigint").alias("total_unreviewed"),
    )
    return lines, totals

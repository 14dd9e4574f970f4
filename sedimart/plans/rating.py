"""Lecturer ratings: typed tables, weighted marks, history, rank and the comment mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.columns import shift_zone, stable_id
from sedimart.operators.aggregates import collapse_max, shrunk_mean
from sedimart.operators.history import scd2_apply, scd2_current
from sedimart.operators.joins import latest_version_join
from sedimart.operators.merge import update_from
from sedimart.operators.ranking import global_rank

# Columns of the rating tables.
MARKS = ["mark_weighted", "mark_kindness_weighted", "mark_clarity_weighted", "mark_freebie_weighted"]
COMMENT_COLUMNS = [
    "create_ts", "update_ts", "subject", "text", "mark_kindness", "mark_freebie", "mark_clarity", "lecturer_id",
    "review_status",
]
LECTURER_COLUMNS = ["first_name", "last_name", "middle_name", "subject", "avatar_link", "timetable_id", *MARKS]


def ods_comment(raw: DataFrame) -> DataFrame:
    return raw.select(
        stable_id("uuid").alias("uuid"),
        F.col("uuid").alias("api_uuid"),
        shift_zone("create_ts").alias("create_ts"),
        shift_zone("update_ts").alias("update_ts"),
        *COMMENT_COLUMNS[2:],
    )


def ods_lecturer_user_comment(raw: DataFrame) -> DataFrame:
    return raw.select(
        stable_id("id").alias("uuid"),
        F.col("id").alias("api_id"),
        "lecturer_id",
        "user_id",
        shift_zone("create_ts").alias("create_ts"),
        shift_zone("update_ts").alias("update_ts"),
    )


def ods_lecturer(lecturers: DataFrame, comments: DataFrame) -> DataFrame:
    """Lecturers with comments, their marks drawn towards the overall mean.

    The overall mark of a comment is the whole-number third of its three marks.
    """
    marks = {
        "mark_weighted": F.expr("(mark_kindness + mark_freebie + mark_clarity) div 3"),
        "mark_kindness_weighted": F.col("mark_kindness"),
        "mark_clarity_weighted": F.col("mark_clarity"),
        "mark_freebie_weighted": F.col("mark_freebie"),
    }
    weighted = shrunk_mean(comments, "lecturer_id", marks, 0.75, "uuid")
    return lecturers.join(weighted, lecturers["id"] == weighted["lecturer_id"]).select(
        stable_id("id").alias("uuid"),
        F.col("id").alias("api_id"),
        "first_name", "last_name", "middle_name", "subject", "avatar_link", "timetable_id",
        *MARKS,
        F.lit(0).alias("rank"),
    )


def dwh_comment(hist: DataFrame, comments: DataFrame, ds: str, compat: bool = False) -> DataFrame:
    return scd2_apply(hist, comments, "api_uuid", COMMENT_COLUMNS, ds, compat, null_safe=["subject"])


def dwh_lecturer(hist: DataFrame, lecturers: DataFrame, ds: str, compat: bool = False) -> DataFrame:
    """History of lecturers; a new version starts without a rank."""
    snap = lecturers.drop("rank")
    fill = {"rank": F.lit(0.0)}
    return scd2_apply(
        hist, snap, "api_id", LECTURER_COLUMNS, ds, compat, null_safe=["subject"], open_only=True, fill=fill
    )


def rank_lecturers(hist: DataFrame) -> DataFrame:
    """Open versions numbered by weighted mark, unknown marks first."""
    live = scd2_current(hist).select("api_id", "mark_weighted", "valid_to_dt")
    ranked = global_rank(live, "mark_weighted", ["api_id"], "rank").select("api_id", "rank")
    return update_from(hist, ranked, ["api_id"], {"rank": lambda old, new: new}, where=F.col("valid_to_dt").isNull())


def comment_mart(comments: DataFrame, lecturers: DataFrame, links: DataFrame, users: DataFrame) -> DataFrame:
    """One row per live comment and newest live version of its lecturer.

    Users are linked to lecturers, not to comments, so the largest user values of a lecturer
    stand at each of its comments; they are taken per lecturer before the comments join.
    """
    live = scd2_current(comments).select("api_uuid", *[F.col(c).alias(f"c_{c}") for c in COMMENT_COLUMNS])
    versions = lecturers.select("api_id", *LECTURER_COLUMNS, "rank", "valid_from_dt", "valid_to_dt")
    newest = latest_version_join(live, versions, "c_lecturer_id", "api_id", "valid_from_dt")
    current = newest.filter(F.col("valid_to_dt").isNull())

    linked = links.select("lecturer_id", F.col("user_id").alias("__uid")).distinct()
    known = users.select(F.col("user_id").alias("__uid"), "full_name", "email")
    per_lecturer = (
        linked.join(known, "__uid", "left")
        .groupBy("lecturer_id")
        .agg(F.max("__uid").alias("user_id"), F.max("full_name").alias("user_full_name"), F.max("email").alias("user_email"))
    )
    # versions that share the newest date collapse to one row
    versions_once = collapse_max(current.drop("valid_to_dt"), ["api_uuid", "api_id", "valid_from_dt"])
    joined = versions_once.join(per_lecturer, F.col("api_id") == F.col("lecturer_id"), "left")
    full_name = F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"), F.lit(" "), F.col("middle_name"))
    return joined.select(
        F.col("api_uuid").alias("comment_api_uuid"),
        F.col("api_id").alias("lecturer_api_id"),
        full_name.alias("lecturer_full_name"),
        "first_name",
        "last_name",
        "middle_name",
        "timetable_id",
        F.col("timetable_id").isNotNull().alias("has_timetable_id"),
        F.coalesce("subject", F.lit("No subject")).alias("lecturer_subject"),
        F.coalesce("c_subject", F.lit("No subject")).alias("comment_subject"),
        F.left("c_text", F.lit(80)).alias("comment_shortened_text"),
        F.col("c_text").alias("comment_full_text"),
        F.col("c_create_ts").alias("comment_create_ts"),
        F.col("c_update_ts").alias("comment_update_ts"),
        F.col("c_mark_kindness").alias("comment_mark_kindness"),
        F.col("c_mark_freebie").alias("comment_mark_freebie"),
        F.col("c_mark_clarity").alias("comment_mark_clarity"),
        F.col("c_review_status").alias("comment_review_status"),
        "user_id",
        "user_full_name",
        "user_email",
        *MARKS,
        "rank",
    )

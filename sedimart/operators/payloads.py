"""JSON payload columns: exploding, typed fields, deep paths, code labels, routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.functions.columns import flag_contains, shift_zone, stable_id
from sedimart.functions.jsontext import json_field, payload_array


def explode_payload(
    df: DataFrame, col: str, out: str = "elem", on_error: str = "raise"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """One row per payload element; an empty array drops the row.

    Malformed text raises; with ``on_error="reject"`` the result is (rows, rejected input rows).
    """
    if on_error == "raise":
        return df.withColumn(out, F.explode(payload_array(col)))
    if on_error != "reject":
        raise ValueError(f"on_error is 'raise' or 'reject', not {on_error!r}")
    parsed = df.withColumn("__elems", payload_array(col, lenient=True))
    good = parsed.filter(F.col("__elems").isNotNull())
    rows = good.withColumn(out, F.explode("__elems")).drop("__elems")
    return rows, parsed.filter(F.col("__elems").isNull()).drop("__elems")


def typed_fields(df: DataFrame, elem: str, spec: dict[str, Column]) -> DataFrame:
    """Replace a payload element by the given field expressions, which win over equal names."""
    kept = [c for c in df.columns if c != elem and c not in spec]
    return df.select(*kept, *[v.alias(k) for k, v in spec.items()])


def json_paths(
    df: DataFrame, col: str, paths: dict[str, tuple[str, str]], required: list[str] | None = None
) -> DataFrame:
    """Deep fields of a JSON text as columns; rows lacking a required one are dropped.

    The text is parsed once per row.
    """
    doc = df.withColumn("__doc", F.parse_json(col))
    out = doc.select(
        *df.columns, *[json_field("__doc", path, kind).alias(name) for name, (path, kind) in paths.items()]
    )
    for name in required or []:
        out = out.filter(F.col(name).isNotNull())
    return out


def code_label(
    df: DataFrame, col: str, mapping: DataFrame, default: str, out: str = "label"
) -> DataFrame:
    """Label of a code from a (code, label) table; the first label of a repeated code, by ``position``.

    The mapping may have a ``position`` column that tells which of two labels comes first.
    """
    order = F.col("position") if "position" in mapping.columns else F.col("label")
    first = mapping.groupBy(F.col("code").cast("string").alias("__code")).agg(F.min_by("label", order).alias("__label"))
    labelled = df.join(first, F.col(col).cast("string") == F.col("__code"), "left")
    return labelled.withColumn(out, F.coalesce("__label", F.lit(default))).drop("__code", "__label")


def route_by_class(df: DataFrame, routes: dict[str, Column]) -> dict[str, DataFrame]:
    """One filtered output per class of row."""
    return {name: df.filter(condition) for name, condition in routes.items()}


def stamp_routes(df: DataFrame, routes: dict[str, Column], out: str = "route") -> DataFrame:
    """The same routing as a column, for writing all classes in one partitioned write."""
    picked = reduce(lambda rest, kv: F.when(kv[1], kv[0]).otherwise(rest), reversed(routes.items()), F.lit(None))
    return df.withColumn(out, picked.cast("string")).filter(F.col(out).isNotNull())


def chat_messages(df: DataFrame, title_part: str, mapping: DataFrame, default: str = "Service chat") -> DataFrame:
    """Messages of the chats whose title contains ``title_part``, with the label of their thread."""
    doc = df.filter(F.col("system") == "TELEGRAM").withColumn("__doc", F.parse_json("message"))
    mine = doc.filter(flag_contains(json_field("__doc", "message.chat.title"), title_part))
    coded = mine.withColumn("__code_in", json_field("__doc", "message.reply_to_message.message_thread_id"))
    labelled = code_label(coded, "__code_in", mapping, default, "thread_name")
    return labelled.select(
        stable_id("message", "event_ts").alias("uuid"),
        "thread_name",
        json_field("__doc", "message.text").alias("message_text"),
        json_field("__doc", "message.from.username").alias("sender_telegram_login"),
        shift_zone("event_ts").alias("message_ts"),
    )


def issue_events(df: DataFrame) -> DataFrame:
    """Issue events of the webhook store, flattened."""
    paths = {
        "status": "action",
        "issue_url": "issue.url",
        "user_login": "issue.user.login",
        "issue_title": "issue.title",
        "created_at": "issue.created_at",
        "updated_at": "issue.updated_at",
        "closed_at": "issue.closed_at",
        "organization_login": "organization.login",
        "assignee_login": "issue.assignee.login",
        "issue_id": "issue.id",
        "user_id": "issue.user.id",
        "repository_id": "repository.id",
        "assignee_id": "issue.assignee.id",
        "organization_id": "organization.id",
    }
    mine = df.filter((F.col("system") == "GITHUB") & F.col("event_ts").isNotNull())
    flat = json_paths(mine, "message", {k: (p, "string") for k, p in paths.items()}, ["status", "issue_id"])
    times = {c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at", "closed_at")}
    return flat.withColumns(times).select(
        stable_id("message", "event_ts").alias("uuid"),
        *list(paths)[:8],
        shift_zone("event_ts").alias("event_ts"),
        *list(paths)[8:],
    )


def flatten_two_arrays(df: DataFrame, a: str, b: str, a_out: str, b_out: str) -> DataFrame:
    """Every pair of a row's elements of two JSON arrays, as VARIANT columns.

    The pairs are the row's own lists crossed, so their number is fixed by the row; an empty
    list drops the row.
    """
    elements = lambda c: F.variant_get(F.parse_json(c), "$", "array<variant>")
    return df.withColumn(a_out, F.explode(elements(a))).withColumn(b_out, F.explode(elements(b)))

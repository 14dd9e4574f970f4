"""Action tables by user class, and front-end actions with their services."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.columns import flag_contains, guarded_int, shift_zone, stable_id
from sedimart.functions.fixed import PRINTER_BOT_USER, PRINTER_USER, RATING_USER
from sedimart.functions.jsontext import field_or, json_field
from sedimart.operators.joins import path_key_join
from sedimart.operators.payloads import explode_payload, route_by_class, typed_fields

def _routes() -> dict:
    return {
        "frontend": F.col("user_id") > 0,
        "printer": F.col("user_id") == PRINTER_USER,
        "printer_bots": (F.col("user_id") == PRINTER_BOT_USER) & F.col("action").isNotNull(),
        "rating": F.col("user_id") == RATING_USER,
    }


def _opened(rows: DataFrame) -> DataFrame:
    key = stable_id("user_id", "action", "path_from", "path_to", "additional_data", "create_ts")
    return explode_payload(rows.withColumn("uuid", key), "additional_data")


def action_tables(actions: DataFrame) -> dict[str, DataFrame]:
    """The four typed action tables of the one landing table."""
    parts = route_by_class(actions, _routes())
    moment = shift_zone("create_ts")
    text = lambda name: field_or("elem", name, "")
    take = lambda name, spec: typed_fields(_opened(parts[name]), "elem", spec).select(*spec)
    auth = json_field("elem", "auth_user_id")
    return {
        "frontend_actions": take(
            "frontend",
            {
                "uuid": F.col("uuid"),
                "user_id": F.col("user_id"),
                "action": F.col("action"),
                "path_from": F.col("path_from"),
                "path_to": F.col("path_to"),
                "user_agent": json_field("elem", "user_agent"),
                "is_bot": flag_contains("additional_data", "bot"),
                "create_ts": moment,
            },
        ),
        "printer_actions": take(
            "printer",
            {
                "uuid": F.col("uuid"),
                "action": F.col("action"),
                "path_from": F.col("path_from"),
                "path_to": F.col("path_to"),
                "status": text("status"),
                "app_version": text("app_version"),
                "create_ts": moment,
            },
        ),
        "printer_bots_actions": take(
            "printer_bots",
            {
                "uuid": F.col("uuid"),
                "action": F.col("action"),
                "path_from": F.col("path_from"),
                "path_to": F.col("path_to"),
                "status": text("status"),
                "user_id": text("user_id"),
                "surname": text("surname"),
                "number": text("number"),
                "pin": guarded_int(json_field("elem", "pin"), 0),
                "status_code": guarded_int(json_field("elem", "status_code")),
                "description": json_field("elem", "description"),
                "create_ts": moment,
            },
        ),
        "rating_actions": take(
            "rating",
            {
                "uuid": F.col("uuid"),
                "action": F.col("action"),
                "path_to": F.col("path_to"),
                "response_status_code": field_or("elem", "response_status_code", "0").cast("int"),
                "user_id": F.when(auth != "Not auth", auth).otherwise("0").cast("int"),
                "query": text("query"),
                "create_ts": moment,
            },
        ),
    }


def frontend_actions_services(actions: DataFrame, buttons: DataFrame) -> DataFrame:
    """Front-end actions that lead to an app, with the services they came from and went to."""
    to_apps = actions.filter(F.ilike("path_to", F.lit("%apps%")))
    named = path_key_join(to_apps, "path_to", buttons, "id", "name", "service_to_name")
    named = path_key_join(named, "path_from", buttons, "id", "name", "service_from_name")
    return named.select(
        "uuid", "user_id", "action", "path_from", "path_to", "user_agent", "is_bot", "create_ts",
        "service_from_name", "service_to_name",
    )

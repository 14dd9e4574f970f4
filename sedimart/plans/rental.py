"""Rental tables: typed refreshes, histories and the mart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.columns import shift_zone, stable_id
from sedimart.operators.history import scd2_apply

# Column -> kind of each typed table; "ts" columns move to Moscow time
TABLES = {
    "event": {"user_id": "", "admin_id": "", "session_id": "", "action_type": "", "details": "", "create_ts": "ts"},
    "item": {"type_id": "", "is_available": ""},
    "item_type": {"name": "", "image_url": "", "description": ""},
    "rental_session": {
        "user_id": "",
        "item_id": "",
        "admin_open_id": "",
        "admin_close_id": "",
        "reservation_ts": "ts",
        "start_ts": "ts",
        "end_ts": "ts",
        "actual_return_ts": "ts",
        "status": "",
    },
    "strike": {"user_id": "", "session_id": "", "admin_id": "", "reason": "", "create_ts": "ts"},
}


def ods_table(name: str, raw: DataFrame) -> DataFrame:
    """Typed full refresh of one rental table; the uuid follows the id, so reloads keep it."""
    cols = [shift_zone(c).alias(c) if kind == "ts" else F.col(c) for c, kind in TABLES[name].items()]
    return raw.select(stable_id("id").alias("uuid"), F.col("id").alias("api_id"), *cols)


def dwh_table(name: str, hist: DataFrame, snap: DataFrame, ds: str) -> DataFrame:
    """History of one rental table, closed and opened by the application's id."""
    return scd2_apply(hist, snap, "api_id", list(TABLES[name]), ds)


@dataclass(frozen=True)
class Rentals:
    """The mart in factors: sessions with their item, type and the sizes of the other two, which hang on the user."""

    sessions: DataFrame
    events: DataFrame
    strikes: DataFrame

    def expanded(self) -> DataFrame:
        """Every session next to each event and each strike of its user, as the warehouse has it."""
        rows = self.sessions.drop("n_events", "n_strikes")
        event = self.events.withColumnRenamed("user_id", "e_user")
        strike = self.strikes.withColumnRenamed("user_id", "s_user")
        joined = rows.join(event, F.col("user_id") == F.col("e_user"), "left").join(strike, F.col("user_id") == F.col("s_user"), "left")
        return joined.drop("e_user", "s_user")


def rentals(sessions: DataFrame, items: DataFrame, item_types: DataFrame, events: DataFrame, strikes: DataFrame) -> Rentals:
    """The factors of the mart.

    A session's row says how many events and strikes its user has, summed before they meet it, so
    no product is built: ``n_events`` times ``n_strikes`` (0 counts as 1) is how many rows it stands for.
    """
    item = items.select(F.col("api_id").alias("i_id"), "type_id")
    kind = item_types.select(F.col("api_id").alias("t_id"), "name", "image_url", "description")
    event = events.select("user_id", "session_id", F.col("admin_id").alias("admin_strike_id"))
    strike = strikes.select("user_id", F.col("reason").alias("strike_reason"), F.col("create_ts").alias("strike_date"))
    count = lambda df, out: df.filter("user_id is not null").groupBy(F.col("user_id").alias(f"__{out}")).agg(F.count(F.lit(1)).alias(out))
    rows = (
        sessions.join(item, F.col("item_id") == F.col("i_id"), "left")
        .join(kind, F.col("type_id") == F.col("t_id"), "left")
        .join(count(event, "n_events"), F.col("user_id") == F.col("__n_events"), "left")
        .join(count(strike, "n_strikes"), F.col("user_id") == F.col("__n_strikes"), "left")
    )
    columns = [
        "uuid", "user_id", "item_id", F.col("admin_open_id").alias("admin_session_open_id"), F.col("admin_close_id").alias("admin_close_session_id"),
        "reservation_ts", "start_ts", "end_ts", "actual_return_ts", "status", "type_id", "name", "image_url", "description",
    ]
    sizes = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_events", "n_strikes")]
    return Rentals(rows.select(*columns, *sizes), event, strike)


def rentals_mart(sessions: DataFrame, items: DataFrame, item_types: DataFrame, events: DataFrame, strikes: DataFrame, compat: bool = False) -> DataFrame:
    """Sessions with item, type and the sizes of their user's events and strikes; with ``compat``, next to each of them."""
    parts = rentals(sessions, items, item_types, events, strikes)
    return parts.expanded() if compat else parts.sessions

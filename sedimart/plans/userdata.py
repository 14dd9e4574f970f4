"""User tables: wide profile, auth-enriched profile, member marts, satellites."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.fixed import PROFILE_PARAMS
from sedimart.operators.aggregates import eav_pivot
from sedimart.operators.joins import member_join
from sedimart.operators.merge import upsert
from sedimart.operators.people import SATELLITES, combine, member_table, merge_satellites, person_facts, user_table
from sedimart.session import materialize


def user_info(info: DataFrame, param: DataFrame) -> DataFrame:
    """Wide profile of every owner (the plain and the encrypted table alike)."""
    names = param.select(F.col("id").alias("param_id"), F.col("name").alias("param_name"))
    facts = info.join(names, "param_id", "left")
    return eav_pivot(facts, "owner_id", "param_name", "value", PROFILE_PARAMS).withColumnRenamed("owner_id", "user_id")


def refresh_user_info(stored: DataFrame, info: DataFrame, param: DataFrame) -> DataFrame:
    fresh = materialize(user_info(info, param))
    return upsert(stored, fresh, ["user_id"], [c for c in fresh.columns if c != "user_id"])


def auth_user(user_info_table: DataFrame, auth_method: DataFrame, auth_users: DataFrame) -> DataFrame:
    """Profiles with the sign-in e-mails and the deletion mark of the account."""
    flags = auth_users.select(F.col("id").alias("user_id"), "is_deleted")
    mails = eav_pivot(auth_method, "user_id", "param", "value", {"email": "auth_email"})
    account = mails.join(flags, "user_id", "left")
    return user_info_table.join(account, "user_id", "left").withColumnRenamed("user_id", "id")


def refresh_auth_user(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    return upsert(stored, materialize(fresh), ["id"], [c for c in fresh.columns if c != "id"])


def member_matches(users: DataFrame, members: DataFrame, trim: bool = False) -> DataFrame:
    """Users and members that share an e-mail.

    Lists are joined with ', ' but split on ',': as in the warehouse, only the first address can
    match, unless ``trim``.
    """
    mine = users.select(F.col("user_id").alias("userdata_user_id"), "full_name", F.col("email").alias("__mails"))
    theirs = members.select(
        "first_name",
        "last_name",
        "type_of_learning",
        F.col("rzd_status").alias("wtf_value"),
        "academic_level",
        "rzd_number",
        "card_id",
        "card_number",
        F.col("email").alias("__mail"),
    )
    return member_join(mine, "__mails", ",", theirs, "__mail", trim).drop("__mails", "__mail")


def refresh_member_join(stored: DataFrame, matches: DataFrame) -> DataFrame:
    """Member mart keyed by full name; of several matches the smallest user and card id wins."""
    order = [F.col("userdata_user_id"), F.col("card_id")]
    return upsert(stored, materialize(matches), ["full_name"], [c for c in matches.columns if c != "full_name"], order)


def member_cards(users: DataFrame, members: DataFrame, trim: bool = False) -> DataFrame:
    return member_matches(users, members, trim).select("userdata_user_id", "card_id", "card_number")


def refresh_satellites(
    stored: dict[str, DataFrame], info: DataFrame, param: DataFrame, source: DataFrame, members: DataFrame, as_of: str
) -> dict[str, DataFrame]:
    """All attribute tables after the run.

    The resolved person table feeds every one of them, so it is computed once and kept in the
    checkpoint folder; one merge serves them all.
    """
    people = combine(user_table(person_facts(info, param, source)), member_table(members))
    return merge_satellites(stored, materialize(people), as_of, SATELLITES)

"""Histories of sign-in methods and accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sedimart.operators.history import scd2_apply

METHOD_COLUMNS = ["user_id", "auth_method", "param", "value", "create_ts", "update_ts", "is_deleted"]
ACCOUNT_COLUMNS = ["create_ts", "update_ts", "is_deleted"]


def method_history(hist: DataFrame, methods: DataFrame, ds: str, compat: bool = False) -> DataFrame:
    return scd2_apply(hist, methods, "id", METHOD_COLUMNS, ds, compat)


def account_history(hist: DataFrame, accounts: DataFrame, ds: str, compat: bool = False) -> DataFrame:
    return scd2_apply(hist, accounts, "id", ACCOUNT_COLUMNS, ds, compat)

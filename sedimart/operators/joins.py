"""Joins with a condition Spark would not hash by itself, rewritten to equality joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from sedimart.functions.columns import array_key, path_tail


def member_join(
    left: DataFrame, list_col: str, sep: str, right: DataFrame, right_col: str, trim: bool = False
) -> DataFrame:
    """``right_col = ANY(split(list_col, sep))`` as an equality join on the exploded list.

    A value that a list repeats matches once.  Parts keep their spaces unless ``trim``.
    """
    parts = F.split(F.col(list_col), f"\\Q{sep}\\E")
    if trim:
        parts = F.transform(parts, lambda x: F.trim(x))
    opened = left.withColumn("__part", F.explode(F.array_distinct(parts)))
    return opened.join(right, F.col("__part") == F.col(right_col)).drop("__part")


def array_set_join(
    left: DataFrame, right: DataFrame, keys: list[str], array_keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join on plain keys and on arrays that are equal as sets; NULL matches nothing.

    The left side's keys are kept; right columns must differ from left ones by name otherwise.
    """
    l_side, r_side = left, right
    for c in array_keys:
        l_side, r_side = l_side.withColumn(f"__l_{c}", array_key(c)), r_side.withColumn(f"__r_{c}", array_key(c))
    r_side = r_side.withColumnsRenamed({c: f"__rk_{c}" for c in keys}).drop(*array_keys)
    on = [F.col(k) == F.col(f"__rk_{k}") for k in keys]
    on += [F.col(f"__l_{c}") == F.col(f"__r_{c}") for c in array_keys]
    joined = l_side.join(r_side, reduce(lambda a, b: a & b, on), how)
    return joined.drop(*[f"__l_{c}" for c in array_keys], *[f"__r_{c}" for c in array_keys], *[f"__rk_{k}" for k in keys])


def path_key_join(left: DataFrame, path_col: str, right: DataFrame, id_col: str, name_col: str, out: str) -> DataFrame:
    """Add ``out``: the right side's name for the id at the end of a path (NULL if there is none)."""
    names = right.select(F.col(id_col).cast("string").alias("__id"), F.col(name_col).alias(out))
    return left.join(names, path_tail(path_col) == F.col("__id"), "left").drop("__id")


def latest_version_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, version_col: str) -> DataFrame:
    """Inner join with the right rows of the newest version per key."""
    dated = right.filter(F.col(right_key).isNotNull() & F.col(version_col).isNotNull())
    place = F.rank().over(Window.partitionBy(right_key).orderBy(F.desc(version_col)))
    last = dated.withColumn("__place", place).filter("__place = 1").drop("__place")
    return left.join(last, F.col(left_key) == F.col(right_key))

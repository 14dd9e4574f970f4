"""Ranking and picking: one row per key, global ranks, numbered batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sedimart.functions.columns import count_known
from sedimart.session import materialize


def best_per_group(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of each group.

    The rank-one filter lets Spark drop the losers before the shuffle, so a hot key sends one
    row per input task and not its whole group.
    """
    group = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(group)).filter("__rn = 1").drop("__rn")


def keep_first(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """Keep-first dedupe with a stated order (``dropDuplicates`` would keep any row)."""
    return best_per_group(df, keys, order_by)


def latest_per_key(df: DataFrame, keys: list[str], ts_col: str, tie: list[Column] | None = None) -> DataFrame:
    """Newest row per key; a NULL time counts as newest, as a descending sort puts it first."""
    return best_per_group(df, keys, [F.col(ts_col).desc_nulls_first(), *(tie or [])])


def latest_attribute(
    df: DataFrame, user: str, attr: str, modified: str = "modified", created: str = "created"
) -> DataFrame:
    """Newest live value per user and attribute, all attributes in one pass."""
    order = [F.col(modified).desc_nulls_first(), F.col(created).desc_nulls_first()]
    tie = [F.col(c) for c in df.columns if c not in (user, attr, modified, created)]
    return best_per_group(df.filter(~F.col("is_deleted")), [user, attr], order + tie)


def completeness_dedupe(df: DataFrame, key: str, cols: list[str], tie: list[Column] | None = None) -> DataFrame:
    """Per key the row with most non-blank values among ``cols``."""
    scored = df.withColumn("completeness_score", count_known(cols))
    return best_per_group(scored, [key], [F.col("completeness_score").desc(), *(tie or [])])


def number_rows(df: DataFrame, order_by: list[Column], out: str = "row_no") -> DataFrame:
    """Number all rows 1..n in a total order, without a one-task window.

    The table is computed once and written with a number for each row; only that and the values it is
    ordered by are sorted over ranges and written with their place in their range. The rows before
    each range come from one count per range, and the other columns meet their number on the row's own.
    End the order with a unique column: it makes the numbers repeatable and spreads a hot value over
    ranges.
    """
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()))
    placed = materialize(rows.orderBy(*order_by).select("__row", F.monotonically_increasing_id().alias("__pos")))
    part = F.shiftright("__pos", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per sort partition, so this window and this broadcast stay small whatever the data
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    numbers = placed.withColumn("__part", part).join(F.broadcast(starts), "__part").select("__row", (F.col("__start") + place).cast("bigint").alias(out))
    return rows.join(numbers, "__row").drop("__row")


def global_rank(df: DataFrame, score: str, tie: list[str], out: str = "rank") -> DataFrame:
    """Rank over the whole table by score, highest first and unknown scores before all."""
    return number_rows(df, [F.col(score).desc_nulls_first(), *[F.col(t) for t in tie]], out)


def batch(df: DataFrame, order_by: list[Column], size: int, out: str = "batch_no") -> DataFrame:
    """Number the batches of ``size`` rows in order, from 0."""
    numbered = number_rows(df, order_by, "row_no")
    return numbered.withColumn(out, F.floor((F.col("row_no") - 1) / size).cast("bigint"))


def top_k(df: DataFrame, order_by: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows; each task keeps only its own best ``k``."""
    return df.orderBy(*order_by).limit(k)

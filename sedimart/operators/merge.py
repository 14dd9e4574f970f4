"""Merges as pure functions (target, source) -> new target.

Conditional merges and upserts tag the rows of both sides, put them together and shuffle that once on
the keys: one sort by key brings each target row next to its source rows, which picks the new values,
checks for repeats and finds the rows to insert. Insert-only merges and updates join the source's keys
without hints, so a small source is broadcast by Spark's own size check and the target not shuffled.
Rows with a NULL key match nothing; they are spread evenly instead of meeting in one task.

Where a mart computes its source, it writes it first (``session.materialize``), so that the work is
not repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sedimart.session import deal

SRC = "__src_"


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def split_null_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose keys are all known, rows with a NULL key)."""
    return df.filter(~_any_null(keys)), df.filter(_any_null(keys))


def _unmatched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is not in the target.

    The keys present on both sides are found from the target's side first, where a small source
    can be broadcast; the anti join then only meets those.
    """
    hit = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    return source.join(hit, keys, "left_anti")


def unique_source(source: DataFrame, keys: list[str], order_by: list[Column] | None) -> DataFrame:
    """One row per key: the first by ``order_by``, or an error at run time if a key repeats."""
    if order_by is not None:
        first = Window.partitionBy(*keys).orderBy(*order_by)
        return source.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")
    rest = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(F.lit(1).alias("__one"), *rest)).alias("__row")
    )
    message = F.concat(F.lit("merge source repeats key "), F.to_json(F.struct(*keys)))
    # in a filter, so that no column pruning drops the check
    checked = grouped.filter(F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*[c if c in keys else F.col("__row")[c].alias(c) for c in source.columns])


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """WHEN NOT MATCHED INSERT: the target as it is, plus every source row without a match.

    Source rows that repeat each other are all inserted; a NULL in a key never matches.
    """
    known, unknown = split_null_keys(source.select(*target.columns), keys)
    return target.unionByName(_unmatched(target, known, keys)).unionByName(unknown)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """ON CONFLICT DO NOTHING: as above, but each new key once."""
    known, unknown = split_null_keys(source.select(*target.columns), keys)
    return target.unionByName(_unmatched(target, known.dropDuplicates(keys), keys)).unionByName(unknown)


def _side_by_side(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both tables, ``__new`` on those of the source; ``__lone`` keeps each row with a NULL key by itself."""
    tagged = target.withColumn("__new", F.lit(False)).unionByName(source.select(*target.columns).withColumn("__new", F.lit(True)))
    apart = 2 * F.monotonically_increasing_id() + F.col("__new").cast("bigint")
    return tagged.withColumn("__lone", F.when(_any_null(keys), apart))


def _repeat_check(fine: Column, keys: list[str]) -> Column:
    """A filter, so that no column pruning drops it."""
    message = F.concat(F.lit("merge source repeats key "), F.to_json(F.struct(*keys)))
    return F.when(fine, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def merge_conditional(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: dict[str, Callable[[Column, Column], Column]],
    matched_if: Callable[[Callable[[str], Column]], Column] | None = None,
    insert_if: Callable[[Callable[[str], Column]], Column] | None = None,
    order_by: list[Column] | None = None,
    unique: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """MERGE with conditions on the source row, in one shuffle of both tables.

    ``update`` maps a column to a function of (old value, new value).  ``matched_if`` and
    ``insert_if`` get a function that looks up a source column.  A target row that several source
    rows would update is an error; with ``unique``, so is any repeated key of the source.  With
    ``order_by`` the first source row of a key by that order stands for all of them.
    ``rows`` tells about how many rows both sides have, if the tasks are to follow that.
    """
    both = _side_by_side(target, source, keys)
    if rows is not None:
        both = deal(both, rows, *keys, "__lone")
    own = Window.partitionBy(*keys, "__lone").orderBy("__new", *(order_by or []))
    group = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    new = F.col("__new")
    hit = new if matched_if is None else new & F.coalesce(matched_if(F.col), F.lit(False))
    both = both.withColumns(
        {
            "__old": F.max(~new).over(group),
            "__times": F.sum((new if unique else hit).cast("int")).over(group),
            "__first": ~F.coalesce(F.lag("__new").over(own), F.lit(False)),
            "__fresh": F.first(F.when(hit, F.struct(F.lit(True).alias("__hit"), *update)), ignorenulls=True).over(group),
        }
    )
    if order_by is None:
        both = both.filter(_repeat_check((F.col("__times") <= 1) | ~(F.col("__old") | F.lit(unique)), keys))
    else:
        both = both.filter(~new | F.col("__first"))
    insert = new & ~F.col("__old")
    if insert_if is not None:
        insert &= insert_if(F.col)
    value = lambda c: F.when(~new & F.col("__fresh").isNotNull(), update[c](F.col(c), F.col("__fresh")[c])).otherwise(F.col(c)).alias(c)
    return both.filter(~new | insert).select(*[value(c) if c in update else F.col(c) for c in target.columns])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    set_cols: list[str],
    order_by: list[Column] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """ON CONFLICT (keys) DO UPDATE SET set_cols; other columns keep the stored value.

    A key that repeats in the source is an error, unless ``order_by`` says which row wins. ``rows`` as above.
    """
    update = {c: (lambda old, new: new) for c in set_cols if c not in keys}
    return merge_conditional(target, source, keys, update, order_by=order_by, unique=True, rows=rows)


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    set_exprs: dict[str, Callable[[Column, Column], Column]],
    where: Column | None = None,
) -> DataFrame:
    """UPDATE ... FROM: matching rows (and ``where``, on target columns) change, others stay.

    Of several source rows of a key the one whose new values sort first is taken.
    """
    known, _ = split_null_keys(source, keys)
    known = unique_source(known.select(*keys, *set_exprs), keys, [F.col(c) for c in set_exprs])
    side = known.select(*keys, *[F.col(c).alias(SRC + c) for c in set_exprs], F.lit(True).alias(SRC))
    applies = F.col(SRC) if where is None else F.col(SRC) & where
    return target.join(side, keys, "left").select(
        *[
            F.when(applies, set_exprs[c](F.col(c), F.col(SRC + c))).otherwise(F.col(c)).alias(c)
            if c in set_exprs
            else F.col(c)
            for c in target.columns
        ]
    )

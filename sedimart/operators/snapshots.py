"""Comparing snapshots and expanding weekly lessons to dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.functions.columns import array_key
from sedimart.operators.merge import update_from
from sedimart.operators.ranking import best_per_group


def page_diff(new: DataFrame, old: DataFrame, key: str, body: str) -> DataFrame:
    """Keys that were added, removed or have another body.

    Only a digest of each body is shuffled, never the body.  A key of both sides with an unknown
    body on either side counts as changed.
    """
    side = lambda df, p: df.select(F.col(key).alias(f"{p}_key"), F.sha2(F.col(body), 256).alias(f"{p}_sum"), F.lit(True).alias(f"{p}_in"))
    both = side(new, "n").join(side(old, "o"), F.col("n_key") == F.col("o_key"), "full_outer")
    change = (
        F.when(F.col("o_in").isNull(), "added")
        .when(F.col("n_in").isNull(), "removed")
        .when(F.coalesce(F.col("n_sum") != F.col("o_sum"), F.lit(True)), "changed")
    )
    return both.select(F.coalesce("n_key", "o_key").alias(key), change.alias("change")).filter("change is not null")


def missing_pages(pages: DataFrame, expected: DataFrame, key: str = "url") -> DataFrame:
    """Expected keys without a page."""
    return expected.select(key).distinct().join(pages.select(key), key, "left_anti")


def require_pages(pages: DataFrame, expected: DataFrame, key: str = "url") -> DataFrame:
    """The pages, or an error if an expected one is missing."""
    lacking = missing_pages(pages, expected, key).count()
    if lacking:
        raise ValueError(f"{lacking} pages are missing from the landing table; missing_pages names them")
    return pages


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: list[str], array_keys: list[str], carried: list[str], id_col: str = "id",
    compat: bool = False,
) -> DataFrame:
    """What to remember, create and delete between two snapshots.

    Rows are the same if all keys are equal and all arrays are equal as sets.  Values come from
    the old row first, the id from the new one.  Arrays are compared by their sorted distinct
    form, so the join stays an equality join; a row with a NULL key can match nothing and is
    kept out of it.  ``compat=True`` tells created from deleted rows by their first key, as the
    warehouse does, so a deleted row without it counts as created.
    """

    def side(df: DataFrame, p: str) -> DataFrame:
        cols = [F.col(c).alias(f"{p}{c}") for c in [*keys, *array_keys, *carried, id_col]]
        return df.select(*cols, *[array_key(c).alias(f"{p}set_{c}") for c in array_keys])

    def known(p: str) -> Column:
        named = [f"{p}{k}" for k in keys] + [f"{p}set_{c}" for c in array_keys]
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in named])

    left, right = side(old, "l_"), side(new, "r_")
    on = [F.col(f"l_{k}") == F.col(f"r_{k}") for k in keys]
    on += [F.col(f"l_set_{c}") == F.col(f"r_set_{c}") for c in array_keys]
    tagged_l, tagged_r = left.withColumn("l_in", F.lit(True)), right.withColumn("r_in", F.lit(True))
    met = tagged_l.filter(known("l_")).join(
        tagged_r.filter(known("r_")), reduce(lambda a, b: a & b, on), "full_outer"
    )
    alone = tagged_l.filter(~known("l_")).unionByName(tagged_r.filter(~known("r_")), allowMissingColumns=True)
    both = met.unionByName(alone)
    action = (
        F.when(F.col("l_in") & F.col("r_in"), "remember")
        .when(F.col(f"l_{keys[0]}").isNull() if compat else F.col("l_in").isNull(), "create")
        .when(F.col(f"r_{keys[0]}").isNull() if compat else F.col("r_in").isNull(), "delete")
    )
    return both.select(
        *[F.coalesce(f"l_{c}", f"r_{c}").alias(c) for c in [*keys, *array_keys, *carried]],
        F.coalesce(f"r_{id_col}", f"l_{id_col}").alias(id_col),
        action.alias("action"),
    )


def carry_over(new: DataFrame, diff: DataFrame, array_col: str, id_col: str = "id") -> DataFrame:
    """Append what the old version had collected to the remembered rows of the new one."""
    kept = diff.filter(F.col("action") == "remember").select(id_col, array_col)
    return update_from(new, kept, [id_col], {array_col: lambda mine, old: F.concat(mine, old)})


def calendar_expand(
    df: DataFrame, begin: str, end: str, semester_start: str, weekday: str = "weekday", odd: str = "odd", even: str = "even"
) -> DataFrame:
    """One row per date on which a weekly lesson takes place, in column ``date``.

    Weekday 0 is Monday.  The week that holds the semester's first day is week 1, an odd one.
    Dates are stepped weekly from the first fitting day, not generated daily and thrown away.
    """
    first, last, start = (F.lit(d).cast("date") for d in (begin, end, semester_start))
    monday = lambda d: F.date_sub(d, F.weekday(d))
    shift = F.pmod(F.col(weekday) - F.weekday(first), F.lit(7)).cast("int")
    first_day = F.date_add(first, shift)
    days = F.when(first_day <= last, F.sequence(first_day, last, F.expr("interval 7 days"))).otherwise(
        F.array().cast("array<date>")
    )
    dated = df.withColumn("date", F.explode(days))
    week = (F.datediff(monday(F.col("date")), monday(start)) / 7).cast("int") + 1
    is_odd = F.pmod(week, F.lit(2)) == 1
    return dated.filter(F.when(is_odd, F.col(odd)).otherwise(F.col(even)))


def lesson_times(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Start and end of a dated lesson as timestamps."""
    moment = lambda c: F.to_timestamp(
        F.concat_ws(" ", F.col("date").cast("string"), F.col(c)), "yyyy-MM-dd H:mm"
    ).cast("timestamp_ntz")
    return df.withColumns({start: moment(start), end: moment(end)})


def dated_events(new: DataFrame, dated: DataFrame, id_col: str = "id", compat: bool = False) -> DataFrame:
    """Weekly rows joined with their dated ones by subject and arrays, one row per
    (subject, start, group, place); the smallest id wins.

    A weekly row without dates stays, with an unknown start; ``compat`` keeps only one such row
    of the whole table, as the warehouse did.
    """
    keys = ["subject", "teacher", "group", "place"]
    side = dated.select(*keys, F.col("start").alias("__start"), F.col("end").alias("__end"), F.lit(True).alias("__met"))
    # dates are exploded from a small table, and Spark takes them to be as small: never broadcast them
    joined = new.drop("start", "end").join(side.hint("merge"), keys, "left")
    named = joined.withColumnsRenamed({"__start": "start", "__end": "end"})
    group = ["subject", "start", "group", "place"]
    if compat:
        shown = {f"__g_{c}": F.when(F.col("__met"), F.col(c)) for c in group}
        return best_per_group(named.withColumns(shown), list(shown), [F.col(id_col)]).drop("__met", *shown)
    return best_per_group(named, group, [F.col(id_col)]).drop("__met")

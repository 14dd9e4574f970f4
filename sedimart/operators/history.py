"""SCD2 history: versions with ``valid_from_dt`` and ``valid_to_dt`` (NULL while open).

Default contract: *close* ends the open versions whose key has no equal row in the snapshot,
*increment* opens a version for every snapshot row without an open one.  Only open versions take
part; closed ones pass through without a shuffle, so the cost of a run follows the live table and
not the length of the history.  A snapshot holds one row per key (exact repeats collapse, others are
an error); rows without a key are told apart by their compared columns.

``compat=True`` gives what the warehouse's SQL did as written, quirks included (closed versions
are stamped again, deleted keys add an all-NULL row, a rerun on the same day inserts again).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

FROM, TO = "valid_from_dt", "valid_to_dt"
SNAP = "__snap_"


def scd2_current(hist: DataFrame) -> DataFrame:
    return hist.filter(F.col(TO).isNull())


def _prefixed(snap: DataFrame, cols: list[str]) -> DataFrame:
    return snap.select(*[F.col(c).alias(SNAP + c) for c in cols], F.lit(True).alias(SNAP))


def _day(ds: str) -> Column:
    return F.lit(ds).cast("date")


def scd2_close(
    hist: DataFrame,
    snap: DataFrame,
    key: str,
    cmp_cols: list[str],
    ds: str,
    compat: bool = False,
    null_safe: list[str] | None = None,
    open_only: bool = False,
) -> DataFrame:
    """History with outdated versions ended on ``ds``.

    ``null_safe`` and ``open_only`` matter only with ``compat``: the columns compared NULL-safe
    (the rest with ``=``), and whether closed versions may vouch for their key.
    """
    if compat:
        return _close_as_written(hist, snap, key, cmp_cols, ds, null_safe or [], open_only)
    closed = hist.filter(F.col(TO).isNotNull())
    return closed.unionByName(_changed(scd2_current(hist), snap.select(*dict.fromkeys([key, *cmp_cols])), key, cmp_cols, ds, opens=False))


def scd2_increment(
    hist: DataFrame,
    snap: DataFrame,
    key: str,
    ds: str,
    compat: bool = False,
    fill: dict[str, Column] | None = None,
) -> DataFrame:
    """History plus a version for every snapshot row whose key is not open.

    History columns that the snapshot lacks come from ``fill``, else they are NULL.
    """
    if compat:
        return hist.unionByName(_increment_as_written(hist, snap, key, ds, fill))
    closed = hist.filter(F.col(TO).isNotNull())
    same = [c for c in hist.columns if c in snap.columns and c not in (FROM, TO)]
    return closed.unionByName(_changed(scd2_current(hist), snap, key, same, ds, closes=False, fill=fill))


def scd2_apply(
    hist: DataFrame,
    snap: DataFrame,
    key: str,
    cmp_cols: list[str],
    ds: str,
    compat: bool = False,
    null_safe: list[str] | None = None,
    open_only: bool = False,
    fill: dict[str, Column] | None = None,
) -> DataFrame:
    """Close and increment; in default mode both come out of one join of live rows and snapshot."""
    if compat:
        ended = scd2_close(hist, snap, key, cmp_cols, ds, True, null_safe, open_only)
        return scd2_increment(ended, snap, key, ds, True, fill)
    closed = hist.filter(F.col(TO).isNotNull())
    return closed.unionByName(_changed(scd2_current(hist), snap, key, cmp_cols, ds, fill=fill))


def _changed(
    live: DataFrame, snap: DataFrame, key: str, cmp_cols: list[str], ds: str, closes: bool = True, opens: bool = True, fill: dict[str, Column] | None = None
) -> DataFrame:
    """The open versions after a snapshot: ended where it has no equal row, and new ones where it has no open one.

    Both tables are tagged, put together and aggregated by key: each is read once, a repeated
    snapshot row collapses before the shuffle, and nothing is joined. Rows without a key take another way.
    """
    cols, from_snap = live.columns, [c for c in live.columns if c in snap.columns and c not in (FROM, TO)]
    known = F.col(key).isNotNull()
    old = live.filter(known).select(F.col(key).alias("__key"), F.struct(*cols).alias("__old"))
    side = snap.filter(known).select(F.col(key).alias("__key"), F.struct(*from_snap).alias("__new"))
    grouped = old.unionByName(side, allowMissingColumns=True).groupBy("__key").agg(
        F.collect_list("__old").alias("__olds"), F.min("__new").alias("__new"), F.max("__new").alias("__last")
    )
    message = F.concat(F.lit("snapshot repeats key "), F.col("__key").cast("string"))
    one = F.when(F.col("__new").eqNullSafe(F.col("__last")), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    types = {f.name: f.dataType for f in live.schema.fields}
    equal = lambda row: F.col("__new").isNotNull() & reduce(lambda a, b: a & b, [row[c].eqNullSafe(F.col("__new")[c]) for c in cmp_cols], F.lit(True))
    ended = lambda row: F.struct(*[F.when(equal(row), row[TO]).otherwise(_day(ds)).cast(types[c]).alias(c) if c == TO else row[c].alias(c) for c in cols])
    rows = F.transform("__olds", ended) if closes else F.col("__olds")
    if opens:
        version = _version({c: F.col("__new")[c] for c in from_snap}, live, ds, fill)
        stays = F.exists("__olds", equal) if closes else F.size("__olds") > 0
        rows = F.concat(rows, F.when(F.col("__new").isNotNull() & ~stays, F.array(F.struct(*version))).otherwise(F.array().cast(live.select(F.array(F.struct(*cols)).alias("a")).schema["a"].dataType)))
    moved = grouped.filter(one).select(F.explode(rows).alias("v")).select("v.*")
    return moved.unionByName(_keyless(live.filter(~known), snap.filter(~known).select(*from_snap), cmp_cols, ds, closes, opens, fill))


def _keyless(live: DataFrame, snap: DataFrame, cmp_cols: list[str], ds: str, closes: bool, opens: bool, fill: dict[str, Column] | None) -> DataFrame:
    """The same for rows without a key, which are told apart by their compared columns.

    Equal rows are counted before anything meets, so however many there are, one row of each kind is
    moved, and they are told out again in the end.
    """
    kind = F.xxhash64(*cmp_cols) if cmp_cols else F.lit(0).cast("bigint")
    cols, from_snap = live.columns, snap.columns
    olds = live.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).select(kind.alias("__kind"), F.struct(*cols, "__n").alias("__old"))
    news = snap.distinct().select(kind.alias("__kind"), F.struct(*from_snap).alias("__new"))
    grouped = olds.unionByName(news, allowMissingColumns=True).groupBy("__kind").agg(F.collect_list("__old").alias("__olds"), F.collect_list("__new").alias("__news"))
    to = F.when(F.size("__news") == 0, _day(ds)) if closes else F.col("v")[TO]
    kept = grouped.select("__news", F.explode("__olds").alias("v")).withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("v.__n"))))
    kinds = {f.name: f.dataType for f in live.schema.fields}
    kept = kept.select(*[(to if c == TO else F.col("v")[c]).cast(kinds[c]).alias(c) for c in cols])
    if not opens:
        return kept
    waiting = grouped.filter(F.size("__olds") == 0).select(F.explode("__news").alias("v"))
    return kept.unionByName(waiting.select(*_version({c: F.col("v")[c] for c in from_snap}, live, ds, fill)))


def _version(values: dict[str, Column], hist: DataFrame, ds: str, fill: dict[str, Column] | None) -> list[Column]:
    """The columns of a new version: its values, else those of ``fill``, else NULL, in the history's types."""
    values = (fill or {}) | values | {FROM: _day(ds), TO: F.lit(None)}
    return [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in hist.schema.fields]


def _as_versions(hist: DataFrame, rows: DataFrame, ds: str, fill: dict[str, Column] | None) -> DataFrame:
    return rows.select(*_version({c: F.col(c) for c in rows.columns if c not in (FROM, TO)}, hist, ds, fill))


def _close_as_written(
    hist: DataFrame, snap: DataFrame, key: str, cmp_cols: list[str], ds: str, null_safe: list[str], open_only: bool
) -> DataFrame:
    side = _prefixed(snap, list(dict.fromkeys([key, *cmp_cols])))
    pool = scd2_current(hist) if open_only else hist
    on = F.col(key) == F.col(SNAP + key)
    for c in cmp_cols:
        on &= F.col(c).eqNullSafe(F.col(SNAP + c)) if c in null_safe else F.col(c) == F.col(SNAP + c)
    matched = pool.join(side, on, "left_semi").select(F.col(key).alias("__hit")).distinct()
    flagged = hist.join(matched, F.col(key) == F.col("__hit"), "left")
    # NULL NOT IN (...) is unknown, unless the list is empty
    none_matched = matched.agg((F.count(F.lit(1)) == 0).alias("none")).scalar()
    outside = F.col("__hit").isNull() & (F.col(key).isNotNull() | none_matched)
    return flagged.withColumn(TO, F.when(outside, _day(ds)).otherwise(F.col(TO))).select(*hist.columns)


def _increment_as_written(
    hist: DataFrame, snap: DataFrame, key: str, ds: str, fill: dict[str, Column] | None
) -> DataFrame:
    stored = hist.select(F.col(key).alias("__key"), F.col(TO).alias("__to"))
    joined = snap.join(stored, F.col(key) == F.col("__key"), "full_outer")
    due = joined.filter(F.col("__key").isNull() | (F.col("__to") == _day(ds)))
    return _as_versions(hist, due.select(*snap.columns), ds, fill)

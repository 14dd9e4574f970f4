"""Cubes, attribute pivots, dimension dedupe and shrunk means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.session import deal


def labelled_cube(
    df: DataFrame, dims: dict[str, Column], counters: dict[str, Column], label: str = "all", compat: bool = False
) -> DataFrame:
    """CUBE with margins labelled and counters defaulting to 0.

    Margins are told from real NULLs by ``grouping_id``; ``compat`` reads both as the margin.
    The cube's copies of a row are combined in the map tasks, before any shuffle.
    """
    keyed = df.select(
        *[v.cast("string").alias(k) for k, v in dims.items()], *[v.alias(f"__c_{k}") for k, v in counters.items()]
    )
    names = list(dims)
    cubed = keyed.cube(*names).agg(
        F.grouping_id().alias("__gid"),
        *[F.coalesce(F.sum(f"__c_{k}"), F.lit(0)).cast("bigint").alias(k) for k in counters],
    )

    def name(i: int, dim: str) -> Column:
        if compat:
            return F.coalesce(F.col(dim), F.lit(label)).alias(dim)
        margin = F.col("__gid").bitwiseAND(F.lit(1 << (len(names) - 1 - i))) != 0
        return F.when(margin, label).otherwise(F.col(dim)).alias(dim)

    return cubed.select(*[name(i, d) for i, d in enumerate(names)], *counters)


def _sorted_text(col: str, sep: str) -> Column:
    """Distinct values of a group, sorted and joined; NULL if there are none."""
    values = F.collect_set(col)
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), sep))


def eav_pivot(
    df: DataFrame,
    owner: str,
    name_col: str,
    value_col: str,
    attrs: dict[str, str],
    source_col: str | None = None,
    sep: str = ", ",
    rows: int | None = None,
) -> DataFrame:
    """One row per owner, one column per attribute: its distinct values, sorted and joined.

    ``attrs`` maps attribute name to output column.  With ``source_col`` each column gets a
    ``_source`` twin.  Owners without any listed attribute keep a row of NULLs.  Repeats are
    removed first, spread over all values, so a hot owner reaches its output cells with its
    distinct values only.  The task that reads the facts gathers nothing, however many it reads.
    They are dealt by owner before cells, and any row as wide as the table, are made of them.
    Both times the number of tasks follows the number of facts: ``rows``, else they are counted.
    """
    listed = F.col(name_col).isin(list(attrs))
    facts = [F.when(listed, F.col(c)).alias(a) for c, a in ((name_col, "__name"), (value_col, "__value"))]
    kinds = {"": "__value"}
    if source_col is not None:
        facts.append(F.when(listed, F.col(source_col)).alias("__source"))
        kinds["_source"] = "__source"
    narrow = df.select(owner, *facts)
    rows = df.count() if rows is None else rows
    distinct = deal(narrow, rows, *narrow.columns).distinct()
    cells = deal(distinct, rows, owner).groupBy(owner, "__name").agg(*[_sorted_text(c, sep).alias(c) for c in kinds.values()])
    return cells.groupBy(owner).agg(
        *[
            F.max(F.when(F.col("__name") == name, F.col(c))).alias(out + suffix)
            for name, out in attrs.items()
            for suffix, c in kinds.items()
        ]
    )


def sorted_set(condition: Column, value: Column) -> Column:
    """``array_agg(DISTINCT CASE WHEN condition THEN value END ORDER BY ...)`` without NULLs."""
    return F.array_sort(F.collect_set(F.when(condition, value)))


def dim_dedupe(
    df: DataFrame, natural: dict[str, Column], id_col: str, out_id: str, min_cols: dict[str, str] | None = None
) -> DataFrame:
    """Dimension by natural key: live rows only, the smallest id stands for the group."""
    live = df.filter(~F.col("is_deleted"))
    return live.groupBy(*[v.alias(k) for k, v in natural.items()]).agg(
        F.min(id_col).alias(out_id), *[F.min(c).alias(o) for c, o in (min_cols or {}).items()]
    )


def shrunk_mean(
    df: DataFrame, key: str, marks: dict[str, Column], weight: float = 0.75, count_col: str | None = None
) -> DataFrame:
    """Per key ``(mean * n + overall mean * weight) / (n + weight)`` for each mark.

    The overall means are taken from the per-key sums, so the marks are read and shuffled once;
    they reach the result as a scalar subquery.
    """
    counted = F.count(count_col) if count_col else F.count(F.lit(1))
    sums = df.groupBy(key).agg(
        counted.alias("n"),
        *[F.sum(m.cast("double")).alias(f"__s_{k}") for k, m in marks.items()],
        *[F.count(m).alias(f"__n_{k}") for k, m in marks.items()],
    )
    overall = sums.agg(
        F.struct(*[(F.sum(f"__s_{k}") / F.sum(f"__n_{k}")).alias(k) for k in marks]).alias("overall")
    ).scalar()
    n = F.col("n")
    shrunk = [
        ((F.col(f"__s_{k}") / F.col(f"__n_{k}") * n + overall.getField(k) * weight) / (n + weight)).alias(k)
        for k in marks
    ]
    return sums.filter(F.col(key).isNotNull()).select(key, n.cast("bigint").alias("n"), *shrunk)


def merge_to_arrays(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Rows that agree on ``keys`` become one, the given columns as sorted distinct arrays."""
    return df.groupBy(*keys).agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols])


def collapse_max(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with the largest value of every other column."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in df.columns if c not in keys])


def newest_cohort(df: DataFrame, modified: str = "modified") -> DataFrame:
    """Live rows that carry the table's newest ``modified``."""
    newest = df.agg(F.max(modified).alias("m")).scalar()
    return df.filter(~F.col("is_deleted") & (F.col(modified) == newest))

"""Table writes: full refresh, slice replacement, dated snapshots, version rotation, retention.

Plain Parquet has no MERGE, and a path cannot be overwritten while it is read.  So a table that
is replaced lives in versioned folders ``root/v=N``: a write adds the next version, readers take
the newest one that carries a ``_SUCCESS`` mark.  A job that dies half way leaves the newest
complete version in force.  The newest two versions stay; older ones go with the next write.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F


# a reader of the version before the newest one, and a rotation, need two
KEPT = 2


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of a table, oldest first (a listing of one folder, no data is read)."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(base):
        return []
    found = []
    for status in files.listStatus(base):
        name = status.getPath().getName()
        if name.startswith("v=") and files.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    return sorted(found)


def read_version(spark: SparkSession, root: str, back: int = 0) -> DataFrame:
    """The newest version, or the one ``back`` versions before it."""
    known = versions(spark, root)
    if len(known) <= back:
        raise FileNotFoundError(f"{root} has {len(known)} complete versions, asked for {back} back")
    return spark.read.parquet(f"{root}/v={known[-1 - back]}")


def full_refresh(df: DataFrame, root: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace the whole table by ``df`` (which may be computed from the table itself)."""
    spark = df.sparkSession
    known = versions(spark, root)
    target = f"{root}/v={known[-1] + 1 if known else 1}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    _drop_versions(spark, root, versions(spark, root)[:-KEPT])
    return spark.read.parquet(target)


def _drop_versions(spark: SparkSession, root: str, old: list[int]) -> None:
    jvm = spark.sparkContext._jvm
    for version in old:
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/v={version}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def rotate_snapshot(df: DataFrame, root: str) -> tuple[DataFrame, DataFrame | None]:
    """Current becomes previous, ``df`` becomes current; returns (current, previous)."""
    current = full_refresh(df, root)
    previous = read_version(df.sparkSession, root, 1) if len(versions(df.sparkSession, root)) > 1 else None
    return current, previous


def replace_slice(target: DataFrame, df: DataFrame, slice_col: str, value: str) -> DataFrame:
    """Rows of one slice replaced by ``df``; rows with an unknown slice stay."""
    other = target.filter(~F.col(slice_col).eqNullSafe(F.lit(value)))
    return other.unionByName(df.withColumn(slice_col, F.lit(value)).select(*target.columns))


def write_slice(df: DataFrame, path: str, slice_col: str, value: str) -> None:
    """Replace the slice ``value`` of a table partitioned by ``slice_col``; no rows leave it empty."""
    df.drop(slice_col).write.mode("overwrite").parquet(f"{path}/{slice_col}={value}")


def append_snapshot(df: DataFrame, path: str, ds: str, date_col: str = "state_dt") -> DataFrame:
    """Add the snapshot of day ``ds``; a rerun of the same day replaces it instead of doubling it."""
    write_slice(df, path, date_col, ds)
    return df.sparkSession.read.parquet(path).withColumn(date_col, F.col(date_col).cast("date"))


def retain(df: DataFrame, ts_col: str, as_of: str | datetime.datetime, days: int = 3) -> DataFrame:
    """Drop rows older than ``days`` before ``as_of``; rows without a time stay."""
    moment = F.lit(as_of).cast(df.schema[ts_col].dataType)
    old = F.col(ts_col) < moment - F.make_dt_interval(days=F.lit(days))
    return df.filter(~F.coalesce(old, F.lit(False)))

"""Schema drift and table sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

COLUMN_LIST = "table_schema string, table_name string, column_name string"


def column_list(spark: SparkSession, tables: dict[tuple[str, str], list[str]]) -> DataFrame:
    """Column lists as rows, one per column of each (schema, table)."""
    rows = [(s, t, c) for (s, t), cols in tables.items() for c in cols]
    return spark.createDataFrame(rows, COLUMN_LIST)


def schema_drift(
    source_cols: DataFrame, target_cols: DataFrame, schema_map: dict[str, str], exclude: tuple[str, ...] = ("alembic_version",)
) -> DataFrame:
    """Columns missing in the target and extra in it, listed per schema and table."""
    renamed = F.col("table_schema")
    for old, new in schema_map.items():
        renamed = F.when(F.col("table_schema") == old, new).otherwise(renamed)
    cols = ["table_schema", "table_name", "column_name"]
    wanted = (
        source_cols.filter(F.col("table_schema").isin(list(schema_map)))
        .withColumn("table_schema", renamed)
        .select(*cols)
    )
    present = target_cols.filter(F.col("table_schema").isin(list(set(schema_map.values())))).select(*cols)
    live = ~F.col("table_name").isin(list(exclude))
    wanted, present = wanted.filter(live), present.filter(live)
    missing = wanted.join(present, cols, "left_anti").withColumn("drift", F.lit("missing in target"))
    extra = present.join(wanted, cols, "left_anti").withColumn("drift", F.lit("extra in target"))
    return (
        missing.unionByName(extra)
        .distinct()
        .groupBy("drift", "table_schema", "table_name")
        .agg(F.array_join(F.array_sort(F.collect_list("column_name")), ", ").alias("columns"))
    )


def table_sizes(tables: dict[tuple[str, str], DataFrame], ds: str) -> DataFrame:
    """Dated size report of file-backed tables, largest first: rows, bytes and whole megabytes.

    Each row knows the file it comes from and that file's size, so no value of a table is read.
    Parquet has no index files, so the index size is 0.
    """
    frames = [
        df.select(F.lit(schema).alias("table_schema"), F.lit(table).alias("table_name"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
        for (schema, table), df in tables.items()
    ]
    files = reduce(DataFrame.unionByName, frames).groupBy("table_schema", "table_name", "path").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    per_table = files.groupBy("table_schema", "table_name").agg(F.sum("rows").alias("n_rows"), F.sum("size").alias("total_bytes"))
    megabytes = F.expr("total_bytes div (1024 * 1024)")
    return per_table.orderBy(F.col("total_bytes").desc(), "table_schema", "table_name").select(
        F.lit(int(ds.replace("-", ""))).alias("id"), "table_name", "table_schema", "n_rows", "total_bytes", megabytes.alias("table_size_mb"),
        F.lit(0).cast("bigint").alias("indexes_size_mb"), megabytes.alias("total_size_mb"), F.lit(ds).cast("date").alias("state_dt"),
    )

"""Container logs: parsing, process lists, attaching names, level counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.functions.columns import Col, as_col
from sedimart.functions.fixed import LOG_PATH, LOOKS_LIKE_JSON, NUL_ESCAPE, PROCESS_LIST
from sedimart.functions.jsontext import json_field
from sedimart.operators.containment import contains_join, window_join
from sedimart.operators.ranking import best_per_group
from sedimart.session import materialize


def _looks_like_json(text: Column) -> Column:
    return text.rlike(LOOKS_LIKE_JSON)


def strip_nul(text: Col) -> Column:
    """Drop ``\\u0000`` escapes; an escaped backslash before ``u0000`` is text and stays."""
    return F.regexp_replace(as_col(text), NUL_ESCAPE, "")


def parse_log(df: DataFrame) -> DataFrame:
    """Shipper rows (id, record, logfile, create_ts) as (id, record, container_id, create_ts).

    The inner record is kept as JSON text: the record itself if it looks like an object, else
    wrapped as its message.  The container is the folder that holds the log file.
    """
    shipped = df.filter(_looks_like_json(F.col("record")) & F.col("logfile").rlike(LOG_PATH))
    inner = shipped.select(
        "id",
        json_field(F.parse_json(strip_nul("record")), "log").alias("__inner"),
        F.regexp_extract("logfile", LOG_PATH, 2).alias("container_id"),
        "create_ts",
    ).filter(F.col("__inner").isNotNull())
    clean = strip_nul("__inner")
    # both branches come out of one pass over the rows
    is_json = _looks_like_json(F.col("__inner"))
    stamped = F.when(is_json, json_field(F.parse_json(clean), "timestamp").cast("timestamp_ntz"))
    message = F.to_json(F.struct(clean.alias("message")))
    return inner.select(
        "id",
        F.when(is_json, clean).otherwise(message).alias("record"),
        "container_id",
        F.coalesce(stamped, F.col("create_ts")).alias("create_ts"),
    )


def parse_processes(df: DataFrame) -> DataFrame:
    """Process list snapshots (record, create_ts): ``id::image::name::status::time`` split by ``^``."""
    body = F.regexp_replace("record", PROCESS_LIST, "$1")
    line = df.select(F.explode(F.split(body, r"\^")).alias("line"), F.col("create_ts").alias("record_create_ts"))
    part = lambda i: F.split_part(F.trim("line"), F.lit("::"), F.lit(i))
    return line.select(
        part(1).alias("container_id"),
        part(2).alias("image_name"),
        part(3).alias("container_name"),
        part(4).alias("status"),
        F.try_to_timestamp(part(5), F.lit("yyyy-MM-dd HH:mm:ss")).alias("create_ts"),
        "record_create_ts",
    )


def latest_names(processes: DataFrame) -> DataFrame:
    """Newest name per container id."""
    newest = [F.col("record_create_ts").desc_nulls_first(), F.col("container_name")]
    return best_per_group(processes, ["container_id"], newest).select("container_id", "container_name")


def log_folders(df: DataFrame) -> DataFrame:
    """Distinct containers of the shipper rows, read from the log paths alone."""
    return df.select(F.regexp_extract("logfile", LOG_PATH, 2).alias("container_id")).filter("container_id <> ''").distinct()


# Lengths of container ids that are looked up one by one; more of them go through a containment join.
ID_LENGTHS = 4


def attach_container(logs: DataFrame, processes: DataFrame, containers: DataFrame | None = None) -> DataFrame:
    """Name every log row by the process whose id is part of its container id.

    Containers are few and log rows many: the containment is settled once per distinct
    container, and the rows then meet the short result on equality.  ``containers`` (from
    ``log_folders``) saves reading the records a second time to find the containers.  Short ids
    have one length or few: each folder name is cut into windows of that length, which meet the ids
    on equality.  Ids of many lengths, or with wildcards, are found by a containment join.
    """
    names = materialize(latest_names(processes).withColumnRenamed("container_id", "__short_id"))
    known = logs.select("container_id").distinct() if containers is None else containers
    folders = known.select(F.col("container_id").alias("__folder"))
    shape = names.agg(
        F.slice(F.sort_array(F.collect_set(F.length("__short_id"))), 1, ID_LENGTHS + 1).alias("lengths"),
        F.coalesce(F.bool_or(F.col("__short_id").rlike(r"[%_\\]") | (F.col("__short_id") == "")), F.lit(False)).alias("patterns"),
    ).first()
    if shape["patterns"] or len(shape["lengths"]) > ID_LENGTHS:
        keyed = folders.withColumn("__folder_id", F.col("__folder"))
        named = contains_join(keyed, names, "__folder_id", "__folder", "__short_id", False)
    else:
        named = reduce(DataFrame.unionByName, [window_join(folders, names, "__folder", "__short_id", n) for n in shape["lengths"] or [1]])
    joined = logs.join(named.select("__folder", "container_name"), F.col("container_id") == F.col("__folder"))
    return joined.select("id", "record", "container_name", "create_ts")


def normalise_level(record: Col) -> Column:
    """Upper-case level of a JSON record, under either of its names."""
    text = as_col(record)
    return F.upper(F.coalesce(F.get_json_object(text, "$.level_name"), F.get_json_object(text, "$.loglevel")))

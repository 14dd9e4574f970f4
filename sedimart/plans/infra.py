"""Container logs: the parsed log, the level cube and the incident history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.columns import in_array, not_in_array, stable_id
from sedimart.functions.fixed import INCIDENT_LEVELS, LOG_LEVELS
from sedimart.operators.aggregates import labelled_cube
from sedimart.operators.logs import attach_container, log_folders, normalise_level, parse_log, parse_processes
from sedimart.operators.merge import merge_conditional, merge_insert_only
from sedimart.session import materialize

COUNTERS = ["debug_cnt", "warn_cnt", "info_cnt", "error_cnt", "critical_cnt", "other_cnt"]


def container_log(raw_log: DataFrame, raw_processes: DataFrame) -> DataFrame:
    return attach_container(parse_log(raw_log), parse_processes(raw_processes), log_folders(raw_log))


def log_cube(log: DataFrame, name_like: str, compat: bool = False) -> DataFrame:
    """Counters per container and day with their margins; ``name_like`` picks the containers."""
    level = F.col("__level")
    leveled = (
        log.filter(F.like("container_name", F.lit(name_like)))
        .withColumn("__level", normalise_level("record"))
        .filter(level.isNotNull())
    )
    one_if = lambda condition: F.when(condition, 1).otherwise(0)
    counters = {c: one_if(level == v) for c, v in zip(COUNTERS, LOG_LEVELS)}
    counters["other_cnt"] = one_if(not_in_array(level, LOG_LEVELS))
    day = F.date_format("create_ts", "yyyy-MM-dd")
    return labelled_cube(leveled, {"container_name": F.col("container_name"), "create_date": day}, counters, "all", compat)


def merge_log_cube(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Counters only grow: a shorter log must not lower what is stored.

    A margin row is stored when it first appears and not touched again; the grand total is
    never stored.
    """
    both_all = lambda c: (c("container_name") == "all") & (c("create_date") == "all")
    any_all = lambda c: (c("container_name") == "all") | (c("create_date") == "all")
    return merge_conditional(
        stored,
        materialize(fresh),  # the cube is small, the log it is counted from is not
        ["container_name", "create_date"],
        {c: F.greatest for c in COUNTERS},
        matched_if=lambda c: ~any_all(c),
        insert_if=lambda c: ~both_all(c),
    )


def incident_history(stored: DataFrame, log: DataFrame, loaded_at: str) -> DataFrame:
    """Error and critical records, each stored once."""
    found = log.filter(in_array(F.get_json_object("record", "$.level_name"), INCIDENT_LEVELS)).select(
        F.get_json_object("record", "$.message").alias("message"), "container_name", "create_ts"
    )
    keys = ["container_name", "message", "create_ts"]
    rows = found.withColumn("id", stable_id(*keys)).withColumn(
        "msk_record_loaded_dttm", F.lit(loaded_at).cast("timestamp_ntz")
    )
    return merge_insert_only(stored, materialize(rows.select(*stored.columns)), keys)

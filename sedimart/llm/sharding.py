"""Sharding by rendezvous hashing: each record goes to the shard that wins its draw, by weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sedimart.session import stage

#: Numbering groups of one shard: a shard's rows are spread over so many, and numbered within each.
SALTS = 1024


def _draw(key: Column, shard: int, weight: float) -> Column:
    """The key's draw for a shard; with weights w the largest draw falls to it with probability w / sum of w."""
    unit = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11) + 0.5) / F.lit(float(2**53))
    return F.lit(float(weight)) / -F.log(unit)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Shard number (from 0) of a key. It depends on the key and the weights alone.

    A null key counts as a key of its own. Draws that tie go to the smaller number. A further shard
    at the end takes keys only into itself, as the draws of the others do not change.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights are positive, one for each shard")
    text = F.coalesce(key.cast("string"), F.lit("\0null"))
    draws = [F.struct(_draw(text, i, w).alias("draw"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)]
    return -F.array_max(F.array(*draws))["shard"]


def assign_shards(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16, weights: list[float] | None = None) -> DataFrame:
    """One row for each record: key, size, text_crc32, law, shard, slot and grown_shard.

    ``shard`` follows from the key and the weights (equal ones unless given); ``grown_shard`` is
    the one after another shard of mean weight joins. Equal keys share a shard. ``size`` counts the
    UTF-8 bytes of the text and one more; a null text has none, and the CRC of none, 0.

    ``slot`` numbers the rows of a shard from 0 without gaps, in no promised order. Rows are spread
    over a fixed number of salts by their place in the input, not by their key, so that copies and
    repeated keys spread too; they are numbered within each salt and shifted by the sizes of the
    salts before. The narrow rows are staged first, so a lost executor changes no salt. Other
    columns are not read.
    """
    weights = weights or [1.0] * shards
    bytes_ = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = df.select(
        F.col(key).alias("key"),
        (F.octet_length(bytes_) + 1).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), [*weights, sum(weights) / len(weights)]).alias("grown_shard"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int").alias("salt"),
    )
    rows = stage(rows, "shards")
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("shard", "salt").agg(F.count("*").alias("n"))
    starts = sizes.select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "salt").orderBy("key", "text_crc32")
    return rows.join(starts, ["shard", "salt"]).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        F.col("grown_shard").cast("int").alias("grown_shard"),
    )

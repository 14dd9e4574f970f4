"""Per-owner keys and encrypted mirrors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.operators.ranking import best_per_group


def generate_keys(users: DataFrame, keys: DataFrame, id_col: str = "id") -> DataFrame:
    """Existing keys unchanged, one new random 128-bit key (base64) per user without a key.

    Random columns change when they are computed again: write the result (for example with
    ``full_refresh``) before anything is encrypted with it.
    """
    missing = users.select(id_col).filter(F.col(id_col).isNotNull()).distinct().join(keys, id_col, "left_anti")
    # two of a UUID's hex digits are fixed, so the key is the digest of two of them
    fresh = F.base64(F.unhex(F.substring(F.sha2(F.concat(F.expr("uuid()"), F.expr("uuid()")), 256), 1, 32)))
    return keys.select(id_col, "key").unionByName(missing.withColumn("key", fresh))


def mirror_encrypted(
    src: DataFrame, keys: DataFrame, encrypt_cols: list[str], owner_col: str, id_col: str = "id"
) -> DataFrame:
    """Rows whose owner has a key, the listed columns encrypted with it; one row per ``id_col``.

    Of rows of one id only those with a key count; of these the one of the smallest owner stays,
    then the one whose columns sort first.

    Each owner has one key, so a hot owner only meets one row of the key table: Spark may
    broadcast the keys if they are small, else the adaptive skew join splits the hot owner.
    """
    owner_key = keys.select(F.col("id").alias("__owner"), F.unbase64("key").alias("__key"))
    keyed = src.join(owner_key, F.col(owner_col) == F.col("__owner"))
    rest = [F.col(f.name) for f in src.schema.fields if f.name not in (id_col, owner_col)]
    joined = best_per_group(keyed, [id_col], [F.col(owner_col), *rest])
    sealed = {c: F.aes_encrypt(F.col(c).cast("string"), F.col("__key")) for c in encrypt_cols}
    return joined.withColumns(sealed).select(*src.columns)


def decrypt(df: DataFrame, keys: DataFrame, encrypt_cols: list[str], owner_col: str) -> DataFrame:
    """Inverse of ``mirror_encrypted`` for the listed columns."""
    owner_key = keys.select(F.col("id").alias("__owner"), F.unbase64("key").alias("__key"))
    joined = df.join(owner_key, F.col(owner_col) == F.col("__owner"))
    opened = {c: F.aes_decrypt(F.col(c), F.col("__key")).cast("string") for c in encrypt_cols}
    return joined.withColumns(opened).select(*df.columns)

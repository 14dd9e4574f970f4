"""Linking texts to names: containment, token match, one winner per text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.functions.text import tokens, tokens_match
from sedimart.operators.containment import contains_join


def token_candidates(
    left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_id: str, right_text: str,
    stops: tuple[str, ...] | None = None,
) -> DataFrame:
    """(left id, right id) for every left row whose tokens include all tokens of a right text.

    Right texts with equal token sets share their links, and only the smallest right id of a set
    is kept.  Each set is looked up by its least used token, so a left row meets the sets of its
    own words and no others.
    """
    sets = (
        right.select(F.col(right_id).alias("__rid"), F.array_sort(tokens(right_text, stops)).alias("__query"))
        .filter(F.size("__query") > 0)
        .groupBy("__query")
        .agg(F.min("__rid").alias("__rid"))
    )
    opened = sets.select("__rid", "__query", F.explode("__query").alias("__token"))
    used = opened.groupBy("__token").agg(F.count(F.lit(1)).alias("__uses"))
    rarest = (
        opened.join(used, "__token")
        .groupBy("__rid")
        .agg(F.min(F.struct("__uses", "__token")).alias("__best"), F.first("__query").alias("__query"))
        .select("__rid", "__query", F.col("__best.__token").alias("__token"))
    )
    # rows meet as (id, token); the full token lists come back only for the rows that met a set
    documents = left.select(F.col(left_id).alias("__lid"), tokens(left_text, stops).alias("__doc"))
    met = (
        documents.select(F.col("__lid").alias("__hit"), F.explode("__doc").alias("__token"))
        .join(rarest, "__token")
        .drop("__token")
    )
    hits = documents.join(met, F.col("__lid") == F.col("__hit")).filter(tokens_match("__doc", "__query"))
    return hits.select(F.col("__lid").alias(left_id), F.col("__rid").alias(right_id))


def link_best(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    left_text: str,
    right_id: str,
    right_text: str,
    contains: bool = True,
    default_unmatched: bool = False,
    stops: tuple[str, ...] | None = None,
) -> DataFrame:
    """One right id per left row: a full token match first, then the smallest id.

    ``contains`` admits only right texts that are part of the left text; rows that share a text
    are one to it, by their smallest id, so no text meets a name more than once.  Without it every right
    row is admitted, so the winner is the best token match or, with ``default_unmatched``, the
    smallest right id of all; no pair beyond the token matches is ever built.
    """
    l_side = left.select(left_id, left_text)
    r_side = right.select(right_id, right_text)
    if contains:
        # in a struct a NULL id is the smallest, as it is among the candidates of one row
        names = r_side.groupBy(right_text).agg(F.min(F.struct(right_id)).alias("__least")).select(F.col(f"__least.{right_id}").alias(right_id), right_text)
        pairs = contains_join(l_side, names, left_id, left_text, right_text)
        full = tokens_match(tokens(left_text, stops), tokens(right_text, stops))
        best = pairs.groupBy(left_id).agg(F.min(F.struct((~full).alias("miss"), F.col(right_id))).alias("best"))
        return best.select(left_id, F.col(f"best.{right_id}").alias(right_id))
    hits = token_candidates(l_side, r_side, left_id, left_text, right_id, right_text, stops)
    best = hits.groupBy(left_id).agg(F.min(right_id).alias(right_id))
    if not default_unmatched:
        return best
    smallest = right.agg(F.min(right_id).alias("m")).scalar()
    chosen = left.select(left_id).join(best.withColumnRenamed(left_id, "__lid"), F.col(left_id) == F.col("__lid"), "left")
    filled = chosen.select(left_id, F.coalesce(F.col(right_id), smallest).alias(right_id))
    return filled.filter(F.col(right_id).isNotNull())

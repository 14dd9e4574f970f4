"""Containment joins: texts and patterns meet on the rarest piece of each pattern, never pair by pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sedimart.functions.columns import like_built
from sedimart.session import materialize

# Kinds of pieces (name, regex whose group 1 is a piece, pieces a pattern must have), best first. A
# piece that follows a space inside the pattern follows one in the text too, so texts are cut at
# their words only; patterns without one use every position of the text.
KINDS = [
    ("w16", r"(?s)\s(?=(\S.{15}))", 4),
    ("w8", r"(?s)\s(?=(\S.{7}))", 1),
    *[(f"c{n}", f"(?s)(?=(.{{{n}}}))", 1) for n in (8, 4, 3, 2, 1)],
]
WORDS, ANY = (0, 1), 2
# Patterns that may share their rarest piece before they are told apart by pieces at any place.
SHARED = 8


def literal_runs(pattern: Column) -> Column:
    """The stretches of a LIKE pattern between ``%``, ``_`` and escapes."""
    return F.split(pattern, r"[%_\\]")


def _pieces(text: Column, kind: int) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(KINDS[kind][1]), F.lit(1)))


def _run_pieces(runs: Column, kind: int) -> Column:
    return F.array_distinct(F.flatten(F.transform(runs, lambda r: _pieces(r, kind))))


def _keyed(pieces: Column, kind: int) -> Column:
    """Pieces as numbers; two that fall together cost a comparison, no more."""
    return F.transform(pieces, lambda p: F.xxhash64(F.lit(kind), p))


def _candidates(patterns: DataFrame, kinds: range) -> DataFrame:
    """(pattern, kind, piece): all pieces of the best kind that each pattern has; kind -1 if it has no literal text."""
    runs = literal_runs(F.col("folded"))
    chosen = []
    for kind in kinds:
        own = _run_pieces(runs, kind)
        chosen.append(F.when(F.size(own) >= KINDS[kind][2], F.struct(F.lit(kind).alias("kind"), _keyed(own, kind).alias("pieces"))))
    none = F.struct(F.lit(-1).alias("kind"), F.array(F.xxhash64(F.lit(-1))).alias("pieces"))
    best = patterns.select("pattern", F.coalesce(*chosen, none).alias("best"))
    return best.select("pattern", F.col("best.kind").alias("kind"), F.explode("best.pieces").alias("piece"))


def _hits(texts: DataFrame, candidates: DataFrame) -> DataFrame:
    """(id, piece): the candidates' pieces in each text, found in one pass, staged."""
    # the kinds in use: at most one per entry of KINDS, whatever the number of patterns
    kinds = sorted(r["kind"] for r in candidates.select("kind").distinct().collect())
    cuts = [F.array(F.xxhash64(F.lit(-1))) if k < 0 else _keyed(_pieces(F.col("folded"), k), k) for k in kinds]
    cut = texts.select("id", F.explode(F.flatten(F.array(*cuts)) if cuts else F.array().cast("array<bigint>")).alias("piece"))
    return materialize(cut.join(candidates.select("piece").distinct(), "piece", "left_semi"))


def _rarest(candidates: DataFrame, hits: DataFrame) -> DataFrame:
    """(pattern, kind, piece) of the piece that fewest texts have; a pattern with a piece in no text is in none."""
    often = hits.groupBy("piece").agg(F.count(F.lit(1)).alias("often"))
    known = candidates.join(often, "piece", "left").select("pattern", F.struct(F.coalesce("often", F.lit(0)).alias("often"), "kind", "piece").alias("use"))
    return known.groupBy("pattern").agg(F.min("use").alias("use")).filter("use.often > 0").select("pattern", "use.kind", "use.piece")


def meetings(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(id, pattern) pairs that may match, of texts (id, folded) and patterns (pattern, folded).

    Pieces are counted in the texts, and a pattern meets only those that hold its rarest one. Patterns that
    share it with more than ``SHARED`` others, as names with one head do, go through a second time: the
    texts that hold that piece are cut at every place, and the patterns choose among all of their pieces.
    """
    candidates = materialize(_candidates(patterns, range(len(KINDS))))
    hits = _hits(texts, candidates)
    best = materialize(_rarest(candidates, hits))
    crowded = best.filter(F.col("kind").isin(*WORDS)).groupBy("piece").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SHARED).select("piece")
    if crowded.isEmpty():
        return hits.join(best, "piece").select("id", "pattern")
    crowded = materialize(crowded)
    met = hits.join(best.join(crowded, "piece", "left_anti"), "piece").select("id", "pattern")
    again = best.join(crowded, "piece", "left_semi").select("pattern")
    around = hits.join(crowded, "piece", "left_semi").select("id").distinct()
    closer = materialize(_candidates(patterns.join(again, "pattern", "left_semi"), range(ANY, len(KINDS))))
    closer_hits = _hits(texts.join(around, "id", "left_semi"), closer)
    return met.unionByName(closer_hits.join(_rarest(closer, closer_hits), "piece").select("id", "pattern"))


def contains_join(left: DataFrame, right: DataFrame, left_id: str, left_text: str, right_text: str, ignore_case: bool = True) -> DataFrame:
    """Pairs with ``left_text [I]LIKE '%' || right_text || '%'``, found through equality joins.

    Whoever contains a pattern contains each of its pieces, so texts and patterns meet on one piece as
    narrow (id, number) rows; only those pairs are compared in full. ``left_id`` is unique; both sides'
    columns are kept and must differ by name. NULL texts and patterns match nothing; a pattern without
    literal text meets every text.
    """
    fold = F.lower if ignore_case else (lambda c: c)
    texts = left.filter(F.col(left_text).isNotNull()).select(F.col(left_id).alias("id"), fold(F.col(left_text)).alias("folded"))
    patterns = right.select(F.col(right_text).alias("pattern")).filter("pattern is not null").distinct().withColumn("folded", fold(F.col("pattern")))
    met = meetings(texts, patterns).select(F.col("id").alias("__id"), F.col("pattern").alias("__pattern"))
    return (
        left.join(met, F.col(left_id) == F.col("__id"))
        .filter(like_built(left_text, "__pattern", ignore_case))
        .join(right, F.col("__pattern") == F.col(right_text))
        .drop("__id", "__pattern")
    )


def window_join(left: DataFrame, right: DataFrame, left_text: str, right_id: str, length: int) -> DataFrame:
    """Pairs whose text contains the id, for ids of one known length: equality on the windows of that length.

    Nothing is compared in full: the window is the id. A text that holds an id twice meets it once.
    """
    starts = F.sequence(F.lit(1), F.greatest(F.length(left_text) - (length - 1), F.lit(1)))
    windows = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(left_text), i, F.lit(length))))
    cut = left.withColumn("__window", F.explode(windows))
    ids = right.filter(F.length(right_id) == length)
    return cut.join(ids, F.col("__window") == F.col(right_id)).drop("__window")

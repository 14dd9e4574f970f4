"""Word tokens for text linking."""

from __future__ import annotations

from functools import lru_cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

from sedimart.functions.columns import Col, as_col
from sedimart.functions.fixed import RUSSIAN_ENDINGS


@lru_cache(maxsize=None)
def stop_words(language: str = "russian") -> tuple[str, ...]:
    """Spark ML's stop word list of a language."""
    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def words(col: Col) -> Column:
    """Lower-case words of a text, punctuation dropped, in text order."""
    return F.filter(F.split(F.lower(as_col(col)), r"(?U)\W+"), lambda w: w != "")


def stem(word: Column) -> Column:
    """Drop a Russian inflection ending; an approximation of a stemmer, other scripts unchanged."""
    return F.regexp_replace(word, rf"(?<=[а-яё]{{3}})(?:{RUSSIAN_ENDINGS})$", "")


def tokens(col: Col, stops: tuple[str, ...] | None = None) -> Column:
    """Distinct stemmed words without stop words; NULL text gives NULL."""
    dropped = stop_words() if stops is None else stops
    kept = words(col)
    if dropped:
        kept = F.array_except(kept, F.array(*[F.lit(w) for w in dropped]))
    return F.array_distinct(F.transform(kept, stem))


def tokens_match(document: Col, query: Col) -> Column:
    """Every query token is in the document; an empty query matches nothing."""
    d, q = as_col(document), as_col(query)
    return F.coalesce((F.size(q) > 0) & (F.size(F.array_except(q, d)) == 0), F.lit(False))

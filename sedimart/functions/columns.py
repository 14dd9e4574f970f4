"""Scalar column builders with the NULL rules the warehouse jobs rely on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

Col = Column | str


def as_col(value: Col) -> Column:
    return F.col(value) if isinstance(value, str) else value


def concat_nulls_empty(*cols: Col) -> Column:
    """Concatenate with NULL read as '' (Spark's ``concat`` returns NULL instead)."""
    return F.concat(*[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])


def is_blank(col: Col) -> Column:
    """True for NULL, '' and spaces only."""
    return F.coalesce(F.trim(as_col(col)) == "", F.lit(True))


def guarded_int(col: Col, default: int | None = None) -> Column:
    """Digits-only text as INT, anything else (NULL too) as ``default``."""
    text = as_col(col)
    return F.when(text.rlike("^[0-9]+$"), text.cast("int")).otherwise(F.lit(default).cast("int"))


def shift_zone(col: Col, source: str = "UTC", target: str = "Europe/Moscow") -> Column:
    """Move a zone-less timestamp from one zone's wall clock to another's."""
    return F.convert_timezone(F.lit(source), F.lit(target), as_col(col).cast("timestamp_ntz"))


def path_tail(col: Col, sep: str = "/") -> Column:
    """Last part of a separated path."""
    return F.split_part(as_col(col), F.lit(sep), F.lit(-1))


def first_item(col: Col, sep: str = ",") -> Column:
    return F.split_part(as_col(col), F.lit(sep), F.lit(1))


def last_item(col: Col, sep: str = ",") -> Column:
    return F.split_part(as_col(col), F.lit(sep), F.lit(-1))


def flag_contains(col: Col, text: str) -> Column:
    """Case-insensitive ``%text%`` test, NULL counts as false."""
    return F.coalesce(F.ilike(as_col(col), F.lit(f"%{text}%")), F.lit(False))


def like_built(text: Col, part: Col, ignore_case: bool = True) -> Column:
    """``text [I]LIKE '%' || part || '%'``: wildcards inside ``part`` keep their meaning."""
    fold = F.lower if ignore_case else (lambda c: c)
    whole, piece = fold(as_col(text)), fold(as_col(part))
    # a backslash before an ordinary character is dropped: Spark rejects it, SQL reads over it; an
    # escaped backslash, wildcard or mark stays as it is
    pattern = F.concat(F.lit("%"), F.regexp_replace(piece, r"(?s)(\\[%_\\])|\\(.)", "$1$2"), F.lit("%"))
    return F.when(piece.rlike(r"[%_\\]"), F.like(whole, pattern)).otherwise(F.contains(whole, piece))


def in_array(value: Col, values: list) -> Column:
    """``value = ANY(values)``."""
    return F.array_contains(F.array(*[F.lit(v) for v in values]), as_col(value))


def not_in_array(value: Col, values: list) -> Column:
    """``value <> ALL(values)``."""
    return ~in_array(value, values)


def differs_from_any(array: Col, value: Col) -> Column:
    """``value != ANY(array)``: true as soon as one known element differs."""
    return F.exists(as_col(array), lambda x: F.coalesce(x != as_col(value), F.lit(False)))


def keep_if(value: Col, *companions: Col) -> Column:
    """The value, but only while it and all companions are known."""
    known = reduce(lambda a, b: a & b, [as_col(c).isNotNull() for c in (value, *companions)])
    return F.when(known, as_col(value))


def same(left: Col, right: Col) -> Column:
    """NULL-safe equality (IS NOT DISTINCT FROM)."""
    return as_col(left).eqNullSafe(as_col(right))


def stable_id(*cols: Col) -> Column:
    """Surrogate key from the natural key, so that reloads do not change it."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("\u0000")) for c in cols]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def array_key(col: Col) -> Column:
    """Sorted distinct form of an array: equal keys mean equal sets; a NULL array stays NULL."""
    return F.array_sort(F.array_distinct(as_col(col)))


def count_known(cols: list[str]) -> Column:
    """How many of the columns hold a non-blank value."""
    return reduce(lambda a, b: a + b, [F.when(is_blank(F.col(c).cast("string")), 0).otherwise(1) for c in cols])


def survive(first: Col, second: Col) -> Column:
    """Both known and different -> 'first, second'; else whichever is known."""
    a, b = as_col(first), as_col(second)
    return F.when(a != b, F.concat_ws(", ", a, b)).otherwise(F.coalesce(a, b))


def survive_source(first: Col, second: Col, first_source: Col, second_source: Col) -> Column:
    """Source tag that goes with ``survive``."""
    a, b = as_col(first), as_col(second)
    return (
        F.when(a != b, concat_nulls_empty(first_source, F.lit(", "), second_source))
        .when(a.isNotNull(), as_col(first_source))
        .when(b.isNotNull(), as_col(second_source))
    )

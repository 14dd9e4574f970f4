"""JSON text columns read through Spark's VARIANT type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sedimart.functions.columns import Col, as_col


def json_field(doc: Col, path: str, kind: str = "string") -> Column:
    """Value at ``$.path`` of a VARIANT; a missing step or JSON null is NULL."""
    return F.variant_get(as_col(doc), f"$.{path}", kind)


def payload_array(text: Col, lenient: bool = False) -> Column:
    """Payload text as an array of VARIANT elements.

    '' is one empty object, an array gives its elements, an object or NULL is one element.
    Malformed text raises, or gives a NULL array when ``lenient``.
    """
    raw = as_col(text)
    parse = F.try_parse_json if lenient else F.parse_json
    doc = F.when(raw == "", F.parse_json(F.lit("{}"))).otherwise(parse(raw))
    is_array = raw.rlike(r"^[ \t\n\r]*\[")
    elements = F.when(is_array, F.variant_get(doc, "$", "array<variant>")).otherwise(F.array(doc))
    if lenient:
        elements = F.when(raw.isNull() | doc.isNotNull(), elements)
    return elements


def field_or(doc: Col, path: str, default: str | None) -> Column:
    """Text field with a default."""
    value = json_field(doc, path)
    return value if default is None else F.coalesce(value, F.lit(default))

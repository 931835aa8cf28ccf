"""Typed values from texts and from JSON values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers with optional thousands separators; labels such as 'Hídrica 1062.14 (75.84%)'.
NUMBER = r"^[+-]?(\d{1,3}(,\d{3})+|\d+)?(\.\d+)?$"
PIE = r"^\s*(.*?)\s+(-?[\d.,]+)\s*\(\s*(-?[\d.,]+)\s*%\s*\)\s*$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _is_number(text: Column) -> Column:
    return text.rlike(NUMBER) & text.rlike(r"\d")


def number_of(text: Column) -> Column:
    """The number that a text states, also with thousands separators or as a percentage; else null."""
    bare = strip(text)
    percent = strip(F.regexp_replace(bare, "%$", ""))
    plain = lambda c: F.regexp_replace(c, ",", "").try_cast("double")
    return F.when(_is_number(bare), plain(bare)).when(bare.endswith("%") & _is_number(percent), plain(percent))


def text_beside(text: Column) -> Column:
    """The text to keep beside ``number_of``: null if it is a plain number."""
    bare = strip(text)
    return F.when(_is_number(bare) & ~bare.contains(","), F.lit(None).cast("string")).otherwise(text)


def json_type(v: str) -> str:
    """SQL: ``null``, ``string``, ``boolean``, ``number``, ``object`` or ``array`` of a variant."""
    # casts of containers are shallow, while the schema of one would be inferred to its depths
    return f"CASE WHEN {v} IS NULL OR is_variant_null({v}) THEN 'null' WHEN try_cast({v} AS array<variant>) IS NOT NULL THEN 'array' WHEN try_cast({v} AS map<string, variant>) IS NOT NULL THEN 'object' ELSE CASE schema_of_variant({v}) WHEN 'STRING' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END END"


def is_empty_text(v: str) -> str:
    """SQL: whether a variant is a text of nothing but white space."""
    return f"coalesce(schema_of_variant({v}) = 'STRING' AND try_cast({v} AS string) RLIKE '^\\\\s*$', false)"


def has_number(v: str) -> str:
    """SQL: whether a variant is a number or a text that states one, as ``number_of`` reads it."""
    text = f"regexp_replace(try_cast({v} AS string), '(?U)^\\\\s+|\\\\s*%?\\\\s*$', '')"
    pattern = NUMBER.replace("\\", "\\\\")
    return f"coalesce(CASE schema_of_variant({v}) WHEN 'STRING' THEN {text} RLIKE '{pattern}' AND {text} RLIKE '[0-9]' WHEN 'BOOLEAN' THEN false WHEN 'VOID' THEN false ELSE try_cast({v} AS double) IS NOT NULL END, false)"


def json_value(v: str) -> tuple[Column, Column]:
    """(value, value_text) of a variant column: numbers, texts of numbers, other texts, booleans, JSON of containers."""
    kind = F.expr(json_type(v))
    text = F.expr(f"try_cast({v} AS string)")
    value = F.when(kind == "number", F.expr(f"try_cast({v} AS double)")).when(kind == "string", number_of(text))
    shown = F.when(kind == "boolean", F.initcap(text)).when(kind == "string", text_beside(text)).when(kind.isin("object", "array"), F.expr(f"to_json({v})"))
    return value, shown


def pie_label(label: Column) -> tuple[Column, Column, Column]:
    """(matches, entity, share) of a pie label."""
    return label.rlike(PIE), F.regexp_extract(label, PIE, 1), F.regexp_extract(label, PIE, 3)

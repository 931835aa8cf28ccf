"""Instants in the source's formats. All expressions give null where a text doesn't fit; the session runs in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import LOCAL_OFFSET

# Spanish months.
MONTHS = {"enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12}
SPANISH = r"^\s*(\d{1,2})-(\p{L}+)-(\d{4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*$"
COMPACT = "yyyyMMdd'T'HHmmss'Z'"


def _ntz(*parts: Column) -> Column:
    """A wall clock of six numbers, null if there is no such time."""
    return F.call_function("try_make_timestamp_ntz", *parts)


def spanish_ts(text: Column) -> Column:
    """'29-septiembre-2026 5:17:08', seconds optional, as a wall clock."""
    part = lambda i: F.nullif(F.regexp_extract(text, SPANISH, i), F.lit(""))
    months = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    month = F.try_element_at(months, F.lower(F.regexp_extract(text, SPANISH, 2)))
    return _ntz(part(3).cast("int"), month, part(1).cast("int"), part(4).cast("int"), part(5).cast("int"), F.coalesce(part(6), F.lit("0")).cast("decimal(16,6)"))


def scada_ts(text: Column) -> Column:
    """'2026-09-29 05:23:54.117', fraction optional, as a wall clock."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"), bare.try_cast("timestamp_ntz"))


def local_to_utc(local: Column) -> Column:
    return F.convert_timezone(F.lit(LOCAL_OFFSET), F.lit("UTC"), local).cast("timestamp")


def utc_to_local(utc: Column) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_OFFSET), utc.cast("timestamp_ntz"))


def point_label(point: str, zero_based: str) -> str:
    """SQL for a trend point's minute label; ``zero_based`` is a boolean expression for its month."""
    number = lambda k: f"try_cast(try_variant_get({point}, '$.time.{k}', 'string') AS int)"
    return f"try_make_timestamp_ntz({number('y')}, {number('m')} + CASE WHEN {zero_based} THEN 1 ELSE 0 END, {number('d')}, {number('h')}, {number('mi')}, 0)"


def format_compact(utc: Column) -> Column:
    return F.date_format(utc, COMPACT)


def parse_compact(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{8}T\d{6}Z$"), F.try_to_timestamp(text, F.lit(COMPACT)))


def iso_ts(text: Column) -> Column:
    """An ISO 8601 instant; without offset it counts as UTC."""
    return text.try_cast("timestamp")


def floor_minute(at: Column) -> Column:
    return F.date_trunc("MINUTE", at)


def minutes(n: int) -> Column:
    """An interval to add to instants."""
    return F.make_dt_interval(mins=F.lit(n))


def month_of_chunk(chunk: Column) -> Column:
    """'202609' of a chunk's name."""
    return F.regexp_extract(chunk, r"_(\d{6})\d{2}T\d{6}Z_", 1)


def mask_digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\d+", "#")

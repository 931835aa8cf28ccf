"""Trend bodies to samples.

A point carries a minute label and one value per series. Its instant is the label plus the seconds of the body's
``update``. Months count from zero unless only counting from one makes the last point agree with ``update``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparse import local_to_utc, point_label, utc_to_local
from ..functions.values import is_empty_text, json_value
from ..schema import TREND, conform
from .explode import parse_bodies

TOLERANCE_S = 120


def decode_trends(bodies: DataFrame) -> DataFrame:
    """One row per ``sin`` body with a trend: ``names``, ``series``, ``labels``, ``zero_based``, ``gap0``, ``gap1``, ``base`` (update or fetch, local).

    ``broken`` marks trends that can't be walked: no object, a last point that is none, a point whose value is a bare
    number or true. They give no values at all and one ``parse_error``.
    """
    parsed = parse_bodies(bodies).filter("endpoint = 'sin' AND kind = 'object' AND try_variant_get(v, '$.trend', 'variant') IS NOT NULL")
    point = "try_variant_get(v, '$.trend.series', 'array<variant>')"
    broken = F.expr(f"""coalesce(schema_of_variant(try_variant_get(v, '$.trend', 'variant')) NOT LIKE 'OBJECT%' OR schema_of_variant(try_element_at({point}, -1)) NOT LIKE 'OBJECT%'
        OR exists({point}, p -> coalesce(try_variant_get(p, '$.value', 'double') <> 0 AND schema_of_variant(try_variant_get(p, '$.value', 'variant')) <> 'STRING' OR try_variant_get(p, '$.value', 'boolean'), false)), false)""")
    base = F.coalesce("update_local", F.date_trunc("SECOND", utc_to_local(F.col("fetched_at_utc"))).cast("timestamp_ntz"))
    read = parsed.select(
        "endpoint", "chunk", "fetched_at_utc", "update_utc", base.alias("base"), broken.alias("broken"),
        F.expr("try_variant_get(v, '$.trend.names', 'array<string>')").alias("names"), F.expr(point).alias("series"),
    )
    gap = lambda zero: F.expr(f"abs(timestampdiff(SECOND, {point_label('try_element_at(series, -1)', zero)}, base))")
    chosen = read.withColumn("gap0", gap("true")).withColumn("gap1", gap("false")).withColumn("zero_based", F.expr(f"NOT (coalesce(gap0, 1e9) > {TOLERANCE_S} AND coalesce(gap1, 1e9) <= {TOLERANCE_S})"))
    # the choice stays outside the lambda, which would otherwise decide anew for each point
    labels = lambda zero: f"transform(series, p -> {point_label('p', zero)})"
    return chosen.withColumn("labels", F.expr(f"CASE WHEN zero_based THEN {labels('true')} ELSE {labels('false')} END"))


def trend_values(decoded: DataFrame) -> DataFrame:
    """One row per point and series with ``label``, ``j``, ``value``, ``is_empty``."""
    points = decoded.filter("not broken").select("chunk", "fetched_at_utc", "update_utc", "base", "names", F.explode(F.arrays_zip("labels", "series")).alias("p"))
    points = points.select("chunk", "fetched_at_utc", "update_utc", "base", "names", F.col("p.labels").alias("label"), F.expr("try_variant_get(p.series, '$.value', 'array<variant>')").alias("_values")).filter("label is not null")
    each = points.select("chunk", "fetched_at_utc", "update_utc", "base", "names", "label", F.posexplode("_values").alias("j", "x"))
    value, _ = json_value("x")
    return each.withColumn("value", value).withColumn("is_empty", F.expr(is_empty_text("x"))).drop("x")


def trend_rows(bodies: DataFrame, with_chunk: bool = False) -> DataFrame:
    """Rows of the TREND schema; empty and unparseable values are left out, series without a name are ``series<j>``.

    ``with_chunk`` adds the chunk that each row came from.
    """
    values = trend_values(decode_trends(bodies)).filter("value is not null and not is_empty")
    local = F.expr("label + make_dt_interval(0, 0, 0, extract(SECOND FROM date_trunc('SECOND', base)))")
    seen = F.coalesce("update_utc", "fetched_at_utc")
    out = values.select(
        "chunk", local_to_utc(local).alias("timestamp_utc"), F.lit("sin.trend").alias("stream"), F.coalesce(F.get("names", F.col("j")), F.concat(F.lit("series"), F.col("j").cast("string"))).alias("entity"),
        F.lit("value").alias("field"), "value", F.lit("MW").alias("unit"), F.col("label").alias("minute_label_local"), seen.alias("first_seen_update_utc"), seen.alias("last_seen_update_utc"),
    )
    return conform(out, T.StructType([*TREND.fields, T.StructField("chunk", T.StringType())])) if with_chunk else conform(out, TREND)

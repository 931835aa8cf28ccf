"""Canonical, minute and hourly views of a versioned series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import local_to_utc
from .dedupe import latest_per_key, span_per_version
from .ordering import every_cell


def versions(trend: DataFrame) -> DataFrame:
    """One row per (entity, instant, value) with the span in which the value was seen."""
    return span_per_version(trend, ("entity", "timestamp_utc", "value"), "first_seen_update_utc", "last_seen_update_utc")


def canonical(trend: DataFrame) -> DataFrame:
    """The value published last per (entity, instant); ties go to the later first sighting, then to the greater value."""
    return latest_per_key(trend, ("entity", "timestamp_utc"), ("last_seen_update_utc", "first_seen_update_utc", "value"))


def minute_means(canonical_rows: DataFrame) -> DataFrame:
    """Mean of the canonical samples per (entity, minute label), with their number. Rows without entity or label are left out."""
    rows = canonical_rows.filter("entity is not null and minute_label_local is not null")
    means = rows.groupBy("entity", "minute_label_local").agg(F.avg("value").alias("value"), F.count("*").alias("n_samples"))
    return means.select(
        local_to_utc(F.col("minute_label_local")).alias("timestamp_utc"), F.col("minute_label_local").alias("timestamp_local"), F.lit("sin.trend.minute").alias("stream"), "entity",
        F.lit("value").alias("field"), "value", F.lit("MW").alias("unit"), "n_samples",
    )


def hourly_means(rows: DataFrame, entity: str = "entity", instant: str = "timestamp_utc", value: str = "value") -> DataFrame:
    """Mean per entity and hour; hours without rows between an entity's first and last come with a null value."""
    hour = F.floor(F.unix_micros(F.col(instant).cast("timestamp")) / 3_600_000_000).cast("long")
    held = rows.filter(F.col(entity).isNotNull() & F.col(instant).isNotNull()).groupBy(F.col(entity).alias("entity"), hour.alias("hour")).agg(F.avg(value).alias("value"))
    bounds = held.groupBy("entity").agg(F.min("hour").alias("first"), F.max("hour").alias("last"))
    grid = every_cell(bounds, ("entity",), "first", "last").withColumnRenamed("cell", "hour")
    return grid.join(held, ["entity", "hour"], "left").select("entity", F.timestamp_seconds(F.col("hour") * 3600).cast("timestamp_ntz").alias("hour"), "value")

"""Exports and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .views import canonical, minute_means


def with_year(rows: DataFrame, instant: str = "timestamp_utc") -> DataFrame:
    return rows.withColumn("year", F.year(instant))


def with_month(rows: DataFrame, instant: str = "timestamp_utc") -> DataFrame:
    return rows.withColumn("month", F.date_format(instant, "yyyy-MM"))


def minute_table(trend: DataFrame) -> DataFrame:
    """Minute means in export format: instants as texts."""
    means = minute_means(canonical(trend))
    return with_year(means).withColumn("timestamp_utc", F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'")).withColumn("timestamp_local", F.date_format("timestamp_local", "yyyy-MM-dd HH:mm:ss"))


def export_all(trend: DataFrame, snapshots: DataFrame, out: str) -> list[str]:
    """Samples by UTC year, minute means by UTC year (Parquet and CSV), snapshots by stream and month. Returns the folders."""
    jobs = {
        "samples": (with_year(trend), ("year",), "parquet"),
        "minute": (minute_table(trend), ("year",), "parquet"),
        "minute_csv": (minute_table(trend), ("year",), "csv"),
        "snapshots": (with_month(snapshots).withColumn("stream_part", F.col("stream")), ("stream_part", "month"), "parquet"),
    }
    for name, (rows, by, fmt) in jobs.items():
        writer = rows.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
        writer.option("header", True).csv(f"{out}/{name}") if fmt == "csv" else writer.option("compression", "zstd").parquet(f"{out}/{name}")
    return [f"{out}/{name}" for name in jobs]


def write_manifests(held: DataFrame, missing: DataFrame, cadence: DataFrame, out: str) -> None:
    """Interval lists (labelled, see ``coverage``) and cadence as single CSV files: one row per interval or day."""
    minute = "yyyy-MM-dd HH:mm"
    for name, runs in (("held", held), ("missing", missing)):
        texts = runs.select(*[F.date_format(c, minute).alias(c) for c in ("start_local", "end_local")], *[F.date_format(c, minute + "'Z'").alias(c) for c in ("start_utc", "end_utc")], "minutes")
        texts.orderBy("start_local").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/{name}_intervals")
    rounded = cadence.select("day_utc", "observations", *[F.bround(c, 2).alias(c) for c in ("median_spacing_min", "p95_spacing_min", "max_spacing_min")], F.bround("pct_of_expected", 1).alias("pct_of_expected"))
    rounded.orderBy("day_utc").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out}/cadence")

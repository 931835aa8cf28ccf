"""Stored series against freshly published ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import exact_quantiles


def safe_corr(x: str, y: str):
    """Pearson correlation; null on a constant column or up to two pairs, instead of raising."""
    pair = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(pair, F.col(x)), F.when(pair, F.col(y))
    return F.when(F.count(a) > 2, F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def window_of(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Fresh rows up to the newest stored instant."""
    return fresh.filter(F.col("timestamp_utc") <= stored.agg(F.max("timestamp_utc")).scalar())


def missing_minutes(window: DataFrame, stored: DataFrame, n_series: int) -> DataFrame:
    """Minute labels of the window that the store doesn't hold for all series."""
    held = stored.groupBy("minute_label_local").agg(F.count_distinct("entity").alias("n"))
    return window.select("minute_label_local").distinct().join(held, "minute_label_local", "left").filter(F.coalesce("n", F.lit(0)) < n_series).select("minute_label_local")


def same_instant(window: DataFrame, canonical_rows: DataFrame) -> DataFrame:
    """Per entity, samples of the same instant: n, exact matches, greatest difference, share of exact ones."""
    pairs = window.select("entity", "timestamp_utc", F.col("value").alias("a")).join(canonical_rows.select("entity", "timestamp_utc", F.col("value").alias("b")), ["entity", "timestamp_utc"]).withColumn("d", F.abs(F.col("a") - F.col("b")))
    return pairs.groupBy("entity").agg(F.count("*").alias("n"), F.count_if(F.col("d") == 0).alias("n_exact"), F.max("d").alias("max_diff"), F.avg(F.coalesce(F.col("d") == 0, F.lit(False)).cast("double")).alias("exact_share"))


def minute_agreement(window: DataFrame, minutes: DataFrame) -> DataFrame:
    """Per entity, fresh values against the stored minute means: n, median and p99 difference, correlation."""
    stored = minutes.select("entity", F.col("timestamp_local").alias("minute_label_local"), F.col("value").alias("b"))
    pairs = window.select("entity", "minute_label_local", F.col("value").alias("a")).join(stored, ["entity", "minute_label_local"]).withColumn("d", F.abs(F.col("a") - F.col("b")))
    facts = pairs.groupBy("entity").agg(F.count("*").alias("n"), safe_corr("a", "b").alias("corr"))
    spread = exact_quantiles(pairs, ("entity",), "d", {"median_diff": 0.5, "p99_diff": 0.99})
    return facts.join(spread, "entity", "left").select("entity", "n", "median_diff", "p99_diff", "corr")


def verdict(missing: DataFrame, agreement: DataFrame, exact: DataFrame, required: tuple[str, ...], exact_entity: str, *, least: int = 60, corr: float = 0.98, median: float = 15.0, share: float = 0.99) -> bool:
    """Whether the store agrees: no minute missing, required entities agree by the minute, one entity matches exactly."""
    off = agreement.filter(F.col("entity").isin(*required) & (F.col("n") > least) & ~F.coalesce((F.col("corr") > corr) & (F.col("median_diff") < median), F.lit(False)))
    wrong = exact.filter((F.col("entity") == exact_entity) & ~(F.col("exact_share") > share))
    return missing.isEmpty() and off.isEmpty() and wrong.isEmpty()

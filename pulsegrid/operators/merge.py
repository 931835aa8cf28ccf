"""Idempotent merges into a partitioned store: only touched partitions are read, only those that change are rewritten."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import key_hash
from ..functions.timeparse import month_of_chunk
from ..schema import SNAPSHOT, SNAPSHOT_KEY, SNAPSHOT_ORDER, TREND, conform
from ..session import drop_path, path_exists, work_path
from .dedupe import first_per_key, upsert_rows
from .views import versions


def _day() -> Column:
    return F.to_date("timestamp_utc")


def digest(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, n, d): count and order-free digest of the rows, to compare content instead of files."""
    rest = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(key_hash(*[F.col(c).cast("string") for c in rest]).cast("decimal(38,0)")).alias("d"))


def in_partitions(keys: tuple[str, ...], parts: list[tuple]) -> Column:
    """Literal filter on partition columns, so that a scan lists and reads these partitions only."""
    if not parts:
        return F.lit(False)
    *head, last = keys
    groups: dict[tuple, list] = {}
    for p in parts:
        groups.setdefault(tuple(p[:-1]), []).append(p[-1])
    each = [reduce(lambda a, b: a & b, [*(F.col(k) == F.lit(v) for k, v in zip(head, values, strict=True)), F.col(last).isin(lasts)]) for values, lasts in groups.items()]
    return reduce(lambda a, b: a | b, each)


def stored_rows(spark: SparkSession, root: str, schema: T.StructType, keys: dict[str, T.DataType]) -> DataFrame | None:
    """The store with its partition columns, null if there is none yet."""
    full = T.StructType([*schema.fields, *[T.StructField(k, t) for k, t in keys.items()]])
    return spark.read.schema(full).parquet(root) if path_exists(spark, root) else None


def merge_partitions(new: DataFrame, root: str, schema: T.StructType, by: dict[str, Column], combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> list[tuple]:
    """Merge ``new`` into ``root`` and return the partitions that changed.

    ``combine`` gets the stored rows of the touched partitions (or None) and the new ones; its result is written to a
    staging table once, and from there only partitions whose digest differs from the stored one replace it (dynamic
    overwrite). Merging the same rows again changes nothing. Rows whose partition is null, those without instant, are
    left out. The list of touched partitions is collected: partitions, not rows.
    """
    spark = new.sparkSession
    keys = tuple(by)
    fresh = conform(new, schema).withColumns(by).filter(" and ".join(f"{k} is not null" for k in keys))
    touched = sorted(tuple(r) for r in fresh.select(*keys).distinct().collect())
    stored = stored_rows(spark, root, schema, {k: fresh.schema[k].dataType for k in keys})
    old = None if stored is None else stored.filter(in_partitions(keys, touched))
    staging = work_path(spark, "merge")
    try:
        combine(None if old is None else old.select(*schema.names), fresh.select(*schema.names)).withColumns(by).write.parquet(staging)
        merged = spark.read.parquet(staging)
        after = digest(merged, keys)
        changed = after if old is None else after.join(digest(old, keys), [*keys, "n", "d"], "left_anti")
        parts = sorted(tuple(r) for r in changed.select(*keys).collect())
        if parts:
            # rebalance: a partition too large for one task is split, small ones share a task
            rewrite = merged.filter(in_partitions(keys, parts)).hint("rebalance", *keys).sortWithinPartitions(*keys, *schema.names[:1])
            rewrite.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*keys).parquet(root)
        return parts
    finally:
        drop_path(spark, staging)


def _union(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if old is None else old.unionByName(new)


def merge_snapshots(new: DataFrame, root: str) -> list[tuple]:
    """Per (stream, day): of several fetches of one reading the first stays."""
    return merge_partitions(new, root, SNAPSHOT, {"stream_part": F.when(F.col("timestamp_utc").isNotNull(), F.coalesce("stream", F.lit("none"))), "day": _day()}, lambda old, rows: first_per_key(_union(old, rows), SNAPSHOT_KEY, SNAPSHOT_ORDER))


def merge_trend(new: DataFrame, root: str) -> list[tuple]:
    """Per day: values of one sample are kept as versions with the span in which they were seen."""
    return merge_partitions(new, root, TREND, {"day": _day()}, lambda old, rows: versions(_union(old, rows)))


def merge_log(new: DataFrame, root: str, schema: T.StructType, key: tuple[str, ...]) -> list[tuple]:
    """Rows of a log by month of their chunk: the stored row of a key stays, of new ones the first by all columns.

    A name that isn't a chunk's belongs to the month ``none``.
    """
    tie = tuple(c for c in schema.names if c not in key)
    month = {"month": F.coalesce(F.nullif(month_of_chunk(F.col("chunk")), F.lit("")), F.lit("none"))}
    return merge_partitions(new, root, schema, month, lambda old, rows: upsert_rows(rows.limit(0) if old is None else old, rows, key, tie))


def read_log(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """A log without its partition column; an absent one is empty."""
    stored = stored_rows(spark, root, schema, {"month": T.StringType()})
    return spark.createDataFrame([], schema) if stored is None else stored.select(*schema.names)

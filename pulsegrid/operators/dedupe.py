"""Keyed deduplication: the first copy, the latest version, versions with their span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _last_nulls(cols: tuple[str, ...]) -> list[Column]:
    """Order columns in which null comes last instead of first."""
    return [x for c in cols for x in (F.col(c).isNull(), F.col(c))]


def first_per_key(rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One whole row per key: the least by ``order`` (nulls last). Null keys are keys too; ties take any of equal rows.

    ``min_by`` combines before the shuffle, so a key that holds a third of all rows leaves each task as one row.
    """
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*_last_nulls(order), *[F.col(c) for c in rest])).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def latest_per_key(rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One whole row per key: the greatest by ``order``, then by the other columns; a null counts as least."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in rows.columns])


def span_per_version(rows: DataFrame, key: tuple[str, ...], first_seen: str, last_seen: str) -> DataFrame:
    """One row per key (value included): least first and greatest last sighting, first non-null of the other columns.

    Null values are versions too. "First non-null" takes the earliest sighting that has one.
    """
    rest = [c for c in rows.columns if c not in (*key, first_seen, last_seen)]
    seen = F.struct(F.col(first_seen).isNull(), F.col(first_seen), F.col(last_seen))
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(seen, F.col(c)))).alias(c) for c in rest]
    return rows.groupBy(*key).agg(*aggs, F.min(first_seen).alias(first_seen), F.max(last_seen).alias(last_seen)).select(*rows.columns)


def upsert_rows(old: DataFrame, new: DataFrame, key: tuple[str, ...], tie: tuple[str, ...] = ()) -> DataFrame:
    """Old rows and those new ones whose key is new; within one side the first by ``tie``."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return first_per_key(both, key, ("_side", *tie)).drop("_side")

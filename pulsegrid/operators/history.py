"""History of changing values: every version with the period it was valid.

Method: the sightings of an entity, as a sorted array of structs, are folded by a higher-order function that appends a
version only upon change; exploding the versions gives each its end.

The fold is associative, so it runs twice: over (entity, span of update time), then over the entity's folded spans. An
entity with very many sightings is spread over its spans, and only its changes are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fold(sightings: Column, kind: str) -> Column:
    """Versions of a sorted array of (from_ms, last_ms, value): a sighting of the last version's value is dropped."""
    return F.aggregate(sightings, F.array().cast(kind), lambda acc, x: F.when((F.size(acc) > 0) & F.element_at(acc, -1)["value"].eqNullSafe(x["value"]), acc).otherwise(F.concat(acc, F.array(x))))


def version_history(
    rows: DataFrame,
    key: tuple[str, ...],
    *,
    value: str = "value",
    first_seen: str = "first_seen_update_utc",
    last_seen: str = "last_seen_update_utc",
    span_ms: int = 21_600_000,
) -> DataFrame:
    """Columns ``key``, ``version`` (from 1), ``n_versions``, ``value``, ``from_ms``, ``to_ms``; ``to_ms`` -1: still valid.

    A row says that a value was seen from its first to its last instant; where one is missing the other stands for
    both, rows with neither or without value don't count. Repeated and overlapping rows of one stay make one version, a
    return to a former value a further one. Sightings that begin together are ordered by their end, then by value.
    """
    first, last = F.unix_millis(first_seen), F.unix_millis(last_seen)
    seen = rows.filter(F.col(value).isNotNull()).select(*key, F.col(value).alias("value"), F.coalesce(first, last).alias("from_ms"), F.coalesce(last, first).alias("last_ms")).filter("from_ms is not null")
    item = F.struct("from_ms", "last_ms", "value")
    kind = f"array<struct<from_ms:bigint,last_ms:bigint,value:{dict(rows.dtypes)[value]}>>"
    spans = seen.groupBy(*key, F.floor(F.col("from_ms") / span_ms).alias("_span")).agg(_fold(F.array_sort(F.collect_list(item)), kind).alias("_part"))
    whole = spans.groupBy(*key).agg(_fold(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_span", "_part"))), lambda s: s["_part"])), kind).alias("_versions"))
    versions = F.transform(
        "_versions",
        lambda x, i: F.struct((i + 1).cast("int").alias("version"), x["value"].alias("value"), x["from_ms"].alias("from_ms"), F.coalesce(F.try_element_at(F.col("_versions"), i + 2)["from_ms"], F.lit(-1).cast("long")).alias("to_ms")),
    )
    return whole.select(*key, F.size("_versions").alias("n_versions"), F.explode(versions).alias("_v")).select(*key, "_v.version", "n_versions", "_v.value", "_v.from_ms", "_v.to_ms")

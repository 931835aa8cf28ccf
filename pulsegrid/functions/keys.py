"""Compact keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_hash(*cols: str | Column) -> Column:
    """64-bit hash of a composite key in which null, '' and shifted values differ.

    Stands for the key where only its *distinct* values count (sources, series): these are few enough that 64 bits
    don't collide. Where every row has its own key, exact columns go along (see ``exactly_once``).
    """
    return F.xxhash64(*[F.coalesce(F.concat(F.lit("="), (F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("~")) for c in cols])


def epoch_ms(col: str | Column) -> Column:
    """Milliseconds since the epoch, rounded down."""
    return F.unix_millis(F.col(col) if isinstance(col, str) else col)

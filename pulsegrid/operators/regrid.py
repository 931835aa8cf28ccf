"""Irregular readings onto a regular grid.

Cells are numbered: cell k covers [k, k + 1) widths since the epoch. ``on_grid`` takes levels, whose readings each stand
for their own cell; ``counter_on_grid`` takes cumulative counters: it detects resets, differences consecutive readings
and shares each increment among the cells it overlaps, in proportion to the overlap. Both mark the cells between the
first and the last of a series that nothing covers (``uncovered_cells``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import with_previous

SPAN = 1440  # cells per block: the arrays below are bounded by it, and a long series spreads over its blocks


def _blocks(covered: DataFrame, series: tuple[str, ...], span: int) -> DataFrame:
    """Series, block and the cells of the block that are covered, for every block from a series' first to its last cell."""
    block = F.floor(F.col("cell") / span).cast("long")
    per = covered.groupBy(*series, block.alias("block")).agg(
        F.collect_set(F.when(F.col("covered"), F.col("cell"))).alias("held"), F.min("cell").alias("lo"), F.max("cell").alias("hi")
    )
    bounds = per.groupBy(*series).agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
    all_blocks = bounds.select(*series, "first", "last", F.explode(F.sequence(F.floor(F.col("first") / span).cast("long"), F.floor(F.col("last") / span).cast("long"))).alias("block"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (*series, "block")]
    return all_blocks.alias("a").join(per.alias("p"), on=same, how="left").select(*[F.col(f"a.{c}").alias(c) for c in (*series, "block", "first", "last")], F.coalesce("p.held", F.array().cast("array<bigint>")).alias("held"))


def _cells_of(block: Column, span: int) -> Column:
    return F.sequence(F.greatest(block * span, F.col("first")), F.least(block * span + span - 1, F.col("last")))


def uncovered_cells(covered: DataFrame, series: tuple[str, ...], span: int = SPAN) -> DataFrame:
    """(series, cell) of the cells between the first and the last ``cell`` of a series for which no row is ``covered``.

    Rows that aren't covered only extend a series; rows without cell don't count. Null series are series.
    """
    blocks = _blocks(covered.filter("cell is not null"), series, span)
    return blocks.select(*series, F.explode(F.array_except(_cells_of(F.col("block"), span), "held")).alias("cell"))


def on_grid(readings: DataFrame, series: tuple[str, ...], cell: Column, value: str, *, span: int = SPAN) -> DataFrame:
    """Columns ``series``, ``cell``, ``value`` (mean of the cell's readings), ``n_samples``, ``is_missing``.

    One row for every cell between the first and the last of a series; missing cells have a null value and no samples.
    Null and NaN values count as no value but do extend the series. An empty table gives no rows.
    """
    valid = F.when(~F.isnan(F.col(value)), F.col(value))
    held = readings.select(*series, cell.alias("cell"), valid.alias("_v")).filter("cell is not null").groupBy(*series, "cell").agg(F.avg("_v").alias("value"), F.count("_v").alias("n_samples"))
    missing = uncovered_cells(held.withColumn("covered", F.col("n_samples") > 0), series, span)
    return (
        held.filter("n_samples > 0")
        .withColumn("is_missing", F.lit(False))
        .unionByName(missing.select(*series, "cell", F.lit(None).cast("double").alias("value"), F.lit(0).cast("long").alias("n_samples"), F.lit(True).alias("is_missing")))
    )


def counter_on_grid(readings: DataFrame, series: tuple[str, ...], instant: str, value: str, *, width_ms: int, max_gap_ms: int | None = None, span: int = SPAN) -> DataFrame:
    """Columns ``series``, ``cell``, ``value`` (increase within the cell), ``covered_ms``, ``is_missing``.

    Consecutive readings are differenced. A fall is a reset: the counter began again at 0, so the reading itself is the
    increment. An increment is shared evenly over its interval. Intervals longer than ``max_gap_ms`` tell nothing of
    when it grew: they give no increment and leave their cells uncovered. Null values and instants are left out; of
    readings at one millisecond the greatest counts.
    """
    block_ms = width_ms * span
    flat = readings.filter(F.col(value).isNotNull() & ~F.isnan(value) & F.col(instant).isNotNull()).groupBy(*series, F.unix_millis(instant).alias("t")).agg(F.max(value).alias("v"))
    paired = with_previous(flat.withColumn("_tv", F.struct("t", "v")), series, F.floor(F.col("t") / block_ms).cast("long"), ("t",), "_tv", "_prev").filter("_prev is not null")
    steps = paired.select(*series, F.col("_prev.t").alias("a"), F.col("t").alias("b"), F.when(F.col("v") < F.col("_prev.v"), F.col("v")).otherwise(F.col("v") - F.col("_prev.v")).alias("inc"))
    if max_gap_ms is not None:
        steps = steps.withColumn("inc", F.when(F.col("b") - F.col("a") <= max_gap_ms, F.col("inc")))
    cut_at = lambda c: F.floor(F.col(c) / width_ms).cast("long")
    # an interval's ends extend the series; its inner cells are listed only where it covers them
    known = steps.filter("inc is not null").select(*series, "a", "b", "inc", F.explode(F.sequence(cut_at("a"), F.floor((F.col("b") - 1) / width_ms).cast("long"))).alias("cell"))
    overlap = F.least("b", (F.col("cell") + 1) * width_ms) - F.greatest("a", F.col("cell") * width_ms)
    shares = known.select(*series, "cell", (F.col("inc") * overlap / (F.col("b") - F.col("a"))).alias("value"), overlap.alias("covered_ms"))
    open_ends = steps.filter("inc is null").select(*series, F.explode(F.array(cut_at("a"), F.floor((F.col("b") - 1) / width_ms).cast("long"))).alias("cell"), F.lit(None).cast("double").alias("value"), F.lit(0).cast("long").alias("covered_ms"))
    cells = shares.unionByName(open_ends).groupBy(*series, "cell").agg(F.sum("value").alias("value"), F.sum("covered_ms").alias("covered_ms"))
    missing = uncovered_cells(cells.withColumn("covered", F.col("covered_ms") > 0), series, span)
    return (
        cells.filter("covered_ms > 0")
        .withColumn("is_missing", F.lit(False))
        .unionByName(missing.select(*series, "cell", F.lit(None).cast("double").alias("value"), F.lit(0).cast("long").alias("covered_ms"), F.lit(True).alias("is_missing")))
    )

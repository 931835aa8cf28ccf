"""Neighbours in an order, without one task per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def every_cell(bounds: DataFrame, by: tuple[str, ...], first: str, last: str, span: int = 4096) -> DataFrame:
    """(by, cell) for every number from ``first`` to ``last``; exploded by blocks, so no array is longer than ``span``."""
    block = lambda c: F.floor(F.col(c) / span).cast("long")
    blocks = bounds.filter(F.col(first) <= F.col(last)).select(*by, first, last, F.explode(F.sequence(block(first), block(last))).alias("_b"))
    return blocks.select(*by, F.explode(F.sequence(F.greatest(F.col("_b") * span, F.col(first)), F.least(F.col("_b") * span + span - 1, F.col(last)))).alias("cell"))


def with_previous(rows: DataFrame, key: tuple[str, ...], block: Column, order: tuple[str, ...], carry: str, into: str) -> DataFrame:
    """Add ``into``: ``carry`` of the row before, per key in ``order`` (unique within a key), null for the first.

    ``block`` must not decrease along ``order`` (a day, say). ``lag`` runs within (key, block); only one row per block,
    its last, goes on to the window over a whole key. A key that holds a third of all rows thus spreads over its blocks.
    """
    blocked = rows.withColumn("_block", block)
    within = Window.partitionBy(*key, "_block").orderBy(*order)
    inner = blocked.withColumn("_lag", F.lag(F.struct(F.col(carry).alias("v"))).over(within))
    last = blocked.groupBy(*key, "_block").agg(F.max_by(F.struct(F.col(carry).alias("v")), F.struct(*order)).alias("_last"))
    before = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(*key).orderBy("_block"))).drop("_last")
    same = [F.col(f"i.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*key, "_block")]
    joined = inner.alias("i").join(before.alias("b"), on=[x for x in same], how="left")
    return joined.select(*[F.col(f"i.{c}").alias(c) for c in rows.columns], F.coalesce(F.col("i._lag"), F.col("b._before"))["v"].alias(into))


def exact_quantiles(rows: DataFrame, key: tuple[str, ...], x: str, quantiles: dict[str, float]) -> DataFrame:
    """(key, one column per quantile): exact, interpolated between neighbours; null and NaN values don't count.

    Values are counted per bin of nearly equal size first. Only the bins that hold a wanted rank are ordered, each on its
    own, so that no task and no buffer sees all values of a key.
    """
    values = rows.filter(F.col(x).isNotNull() & ~F.isnan(x)).groupBy(*key, F.col(x).cast("double").alias("_x")).agg(F.count("*").alias("_n"))
    size = F.abs("_x")
    values = values.withColumn("_bin", F.when(size > 0, F.signum("_x") * (F.floor(F.log2(size) * 64) + 1_000_000)).otherwise(0.0).cast("long"))
    w = Window.partitionBy(*key)
    bins = values.groupBy(*key, "_bin").agg(F.sum("_n").alias("_m"))
    bins = bins.withColumn("_before", F.sum("_m").over(w.orderBy("_bin")) - F.col("_m")).withColumn("_all", F.sum("_m").over(w))
    at = lambda q: (F.col("_all") - 1) * F.lit(float(q))
    ranks = F.array(*[F.struct(F.lit(name).alias("q"), side(at(q)).cast("long").alias("rank"), (at(q) - F.floor(at(q))).alias("part"), F.lit(k).alias("side")) for name, q in quantiles.items() for k, side in enumerate((F.floor, F.ceil))])
    wanted = bins.select(*key, "_bin", "_before", "_m", F.explode(ranks).alias("_r")).filter((F.col("_r.rank") >= F.col("_before")) & (F.col("_r.rank") < F.col("_before") + F.col("_m")))
    v, t = values.alias("v"), wanted.alias("t")
    met = v.join(t, on=[F.col(f"v.{c}").eqNullSafe(F.col(f"t.{c}")) for c in (*key, "_bin")]).select(*[F.col(f"v.{c}").alias(c) for c in key], "v._bin", "v._x", "v._n", "t._before", "t._r")
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*key, "_bin", "_r").orderBy("_x"))
    found = met.withColumn("_upto", upto).filter("_upto > _r.rank").groupBy(*key, F.col("_r.q").alias("_q"), F.col("_r.part").alias("_part")).agg(F.min(F.when(F.col("_r.side") == 0, F.col("_x"))).alias("_lo"), F.min(F.when(F.col("_r.side") == 1, F.col("_x"))).alias("_hi"))
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")
    return found.groupBy(*key).agg(*[F.max(F.when(F.col("_q") == name, value)).alias(name) for name in quantiles])

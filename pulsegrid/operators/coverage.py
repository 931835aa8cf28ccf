"""Completeness: which minutes are held, where gaps lie, how often values are revised, how evenly updates come.

A minute is held if every series has a sample in it. The window runs from the first held minute to the last of any.
Cells are numbered minutes (or hours); a table of cells is small next to its samples, and everything here groups it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import every_cell, with_previous


def label_minute(label: str) -> Column:
    """The number of a label's minute: labels are wall clock, so the cells and their intervals are local."""
    return F.floor(F.unix_micros(F.col(label).cast("timestamp")) / 60_000_000).cast("long")


def held_cells(samples: DataFrame, series: str, cell: Column) -> DataFrame:
    """(cell, n_series): how many series have a sample in a cell. Null series and cells don't count."""
    return samples.select(F.col(series).alias("series"), cell.alias("cell")).filter("series is not null and cell is not null").groupBy("cell").agg(F.count_distinct("series").alias("n_series"))


def grid(samples: DataFrame, series: str, cell: Column, since: int | None = None, until: int | None = None) -> DataFrame:
    """(cell, is_held) for every cell of the window; ``since`` and ``until`` replace its ends. Empty if nothing is complete."""
    held = held_cells(samples, series, cell)
    every = samples.select(F.count_distinct(series).alias("n_all"))
    marked = held.select("cell", (F.col("n_series") == every.scalar()).alias("is_held"))
    first = F.lit(since) if since is not None else F.min(F.when(F.col("is_held"), F.col("cell")))
    last = F.lit(until) if until is not None else F.max("cell")
    bounds = marked.agg(first.cast("long").alias("a"), last.cast("long").alias("b"))
    return every_cell(bounds, (), "a", "b").join(marked, "cell", "left").select("cell", F.coalesce("is_held", F.lit(False)).alias("is_held"))


def intervals(cells: DataFrame, by: tuple[str, ...] = (), block: int = 4096) -> DataFrame:
    """Runs of consecutive ``cell`` as (by, start_cell, end_cell, n_cells): gaps and islands.

    Islands form within blocks of cells. Only those that touch a block's edge, at most two a block, can go on in the
    next one: they alone are ordered across blocks. Repeated cells count once.
    """
    once = cells.select(*by, "cell").distinct().withColumn("_b", F.floor(F.col("cell") / block))
    inner = once.withColumn("_g", F.col("cell") - F.row_number().over(Window.partitionBy(*by, "_b").orderBy("cell"))).groupBy(*by, "_b", "_g").agg(F.min("cell").alias("a"), F.max("cell").alias("b"))
    at_edge = (F.col("a") == F.col("_b") * block) | (F.col("b") == F.col("_b") * block + block - 1)
    inner = inner.withColumn("_own", F.when(~at_edge, F.col("_b")))
    w = Window.partitionBy(*by, "_own").orderBy("a")
    fresh = F.when(F.col("_own").isNull() & (F.col("a") == F.lag("b").over(w) + 1), 0).otherwise(1)
    runs = inner.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*by, "_own", "_run").agg(F.min("a").alias("start_cell"), F.max("b").alias("end_cell")).select(*by, "start_cell", "end_cell", (F.col("end_cell") - F.col("start_cell") + 1).alias("n_cells"))


def label_intervals(runs: DataFrame) -> DataFrame:
    """Interval columns of the manifests: local and UTC ends, and minutes."""
    at = lambda c, s: F.timestamp_seconds(F.col(c) * 60 + s)
    local = lambda c: at(c, 0).cast("timestamp_ntz")
    return runs.select(local("start_cell").alias("start_local"), local("end_cell").alias("end_local"), at("start_cell", 18_000).alias("start_utc"), at("end_cell", 18_000).alias("end_utc"), F.col("n_cells").alias("minutes"))


def coverage_summary(window: DataFrame) -> DataFrame:
    """One row: expected and held cells, and the share that is held (null without window)."""
    return window.agg(F.count("*").alias("n_expected"), F.count_if("is_held").alias("n_held"), F.avg(F.col("is_held").cast("double")).alias("completeness"))


def held_per_series(samples: DataFrame, series: str, cell: Column, window: DataFrame) -> DataFrame:
    """How many of the window's cells each series has."""
    return samples.select(F.col(series).alias("series"), cell.alias("cell")).filter("series is not null").distinct().join(window.select("cell"), "cell", "left_semi").groupBy("series").agg(F.count("*").alias("n_held"))


def phases(samples: DataFrame, instant: str, cell: Column, window: DataFrame) -> DataFrame:
    """(cell, n_phases): distinct sample instants in each held cell."""
    per = samples.select(cell.alias("cell"), F.col(instant).alias("t")).groupBy("cell").agg(F.count_distinct("t").alias("n_phases"))
    return window.filter("is_held").select("cell").join(per, "cell", "left").select("cell", F.coalesce("n_phases", F.lit(0)).alias("n_phases"))


def phase_histogram(per_cell: DataFrame) -> DataFrame:
    return per_cell.groupBy("n_phases").agg(F.count("*").alias("n_cells"))


def revision_stats(versions: DataFrame, series: str, instant: str) -> DataFrame:
    """Per series: samples, and how many of them have more than one version."""
    return versions.groupBy(F.col(series).alias("series"), instant).agg(F.count("*").alias("n")).groupBy("series").agg(F.count("*").alias("n_samples"), F.count_if(F.col("n") > 1).alias("n_revised"))


def cadence(updates: DataFrame, instant: str, expected_per_day: int = 288) -> DataFrame:
    """Per UTC day: distinct updates, median, 95th percentile and greatest spacing in minutes, percentage of the expected.

    Spacings are within a day, so the window's partitions are days. A day with one update has null spacings.
    """
    once = updates.select(F.col(instant).alias("t")).filter("t is not null").distinct().withColumn("day_utc", F.to_date("t"))
    spaced = once.withColumn("gap", (F.unix_micros(F.col("t").cast("timestamp")) - F.unix_micros(F.lag("t").over(Window.partitionBy("day_utc").orderBy("t")).cast("timestamp"))) / 6e7)
    return spaced.groupBy("day_utc").agg(
        F.count("*").alias("observations"), F.median("gap").alias("median_spacing_min"), F.percentile("gap", 0.95).alias("p95_spacing_min"), F.max("gap").alias("max_spacing_min"), (100 * F.count("*") / F.lit(expected_per_day)).alias("pct_of_expected")
    )


def step_anomalies(rows: DataFrame, key: tuple[str, ...], at: str, step_s: int) -> DataFrame:
    """Per key: how many steps between consecutive distinct non-null ``at`` aren't ``step_s`` seconds.

    Neighbours are found within days; a key holding most rows spreads over its days.
    """
    once = rows.select(*key, F.unix_micros(F.col(at).cast("timestamp")).alias("_t")).filter("_t is not null").distinct()
    paired = with_previous(once, key, F.floor(F.col("_t") / 86_400_000_000).cast("long"), ("_t",), "_t", "_before")
    return paired.groupBy(*key).agg(F.count_if(F.col("_t") - F.col("_before") != step_s * 1_000_000).alias("n_steps"))


def new_intervals(now: DataFrame, before: DataFrame) -> DataFrame:
    """Intervals that the earlier list doesn't have."""
    return now.select("start_cell", "end_cell").subtract(before.select("start_cell", "end_cell"))


def top_intervals(runs: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` intervals, each with ``n_more``: how many follow them unlisted."""
    more = F.greatest(runs.agg(F.count("*")).scalar() - n, F.lit(0))
    return runs.orderBy("start_cell").limit(n).withColumn("n_more", more)


def last_days(cadence_rows: DataFrame, n: int = 31) -> DataFrame:
    """The latest ``n`` days of a cadence table."""
    return cadence_rows.orderBy(F.desc("day_utc")).limit(n)


def report(samples: DataFrame, series: str, cell: Column, instant: str, versions: DataFrame, cadence_rows: DataFrame, since: int | None = None, until: int | None = None) -> str:
    """Completeness as text: window, share held, series, the first 50 gaps, revisions, the last 31 days of cadence.

    What is collected is one row per series, 50 gaps and 31 days.
    """
    window = grid(samples, series, cell, since, until)
    whole = coverage_summary(window).first()
    if not whole.n_expected:
        return "No trend data."
    lines = [f"minutes expected {whole.n_expected:,}, held {whole.n_held:,}, missing {whole.n_expected - whole.n_held:,}", f"completeness {100 * whole.completeness:.3f} %"]
    lines += [f"  {r.series}: {r.n_held:,} minutes" for r in held_per_series(samples, series, cell, window).orderBy("series").collect()]
    spread = phases(samples, instant, cell, window).agg(F.avg("n_phases").alias("mean"), F.min("n_phases").alias("least")).first()
    if spread.mean is not None:
        lines.append(f"distinct instants per held minute: mean {spread.mean:.2f}, least {spread.least}")
    gaps = top_intervals(intervals(window.filter("not is_held"))).collect()
    lines.append(f"missing intervals: {len(gaps) + (gaps[0].n_more if gaps else 0)}")
    spark = samples.sparkSession
    texts = label_intervals(spark.createDataFrame(gaps, "start_cell long, end_cell long, n_cells long, n_more long")).orderBy("start_local") if gaps else None
    lines += [f"  {r.start_local:%Y-%m-%d %H:%M} to {r.end_local:%Y-%m-%d %H:%M} local, {r.minutes} min" for r in (texts.collect() if texts is not None else [])]
    if gaps and gaps[0].n_more:
        lines.append(f"  and {gaps[0].n_more} more")
    lines += [f"revised {r.series}: {r.n_revised:,} of {r.n_samples:,} samples" for r in revision_stats(versions, series, "timestamp_utc").orderBy("series").collect()]
    days = sorted(last_days(cadence_rows).collect(), key=lambda r: str(r.day_utc))
    lines += [f"{r.day_utc}: {r.observations} updates, {r.pct_of_expected:.1f} % of expected" for r in days] or ["no snapshot data"]
    return "\n".join(lines)

"""Implausible readings: spikes, impossible values and stuck values, judged against their own source.

Method: phase-space thresholding. The deviation ``u`` of a reading from its running median and the first and second
differences of ``u`` span a space in which normal readings fill an ellipsoid; its half axes are robust scales times the
universal threshold ``sqrt(2 ln n)``. Readings outside are replaced, again and again until none is left; then the axes
and the tilt are fitted anew to what remained, and the ellipsoids applied with them. A reading outside counts as a spike
if it also departs by ``spike_sigmas`` scales of its source, or stands out of an otherwise unchanging stretch. Runs
without change that are longer than the source's own rate of repeated values allows are stuck; values of a sign or size
that the source never has are impossible.

Scale: a source is cut into blocks of about ``block_rows`` readings, found from counts per source and hour, with
``halo_rows`` readings of the neighbouring blocks. A hot source is thus spread over many tasks. Everything that a source
has in common is a count or a histogram, summed over its blocks before any reading is judged, and what is judged looks
no farther than the halo: where the blocks are cut doesn't matter. Passes over the blocks send on histograms, findings
and the runs that touch a block's edge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import epoch_ms, key_hash
from ..session import cut, store

HALF = 5  # the running median spans 2 * HALF + 1 readings: an excursion of up to HALF readings is a spike
ROUNDS = 8  # rounds of replacing with one set of axes; each looks two readings farther
FLAT = 8  # readings that a stretch without change has at least
MIN_ACTIVE = 12  # fewer readings give no scale
BINS = 16  # bins of a histogram per doubling
EPS = 1e-9

BLOCK_DDL = "src long, blk long, ms array<long>, v array<double>, core array<boolean>"
STAT_DDL = "src long, kind string, bin int, n long, hi double, total double"
FOUND_DDL = "src long, blk long, kind int, ms long, value double, reason string, first_ms long, n long, open_left boolean, open_right boolean, run_ms array<long>"
STAT = pa.schema([("src", pa.int64()), ("kind", pa.string()), ("bin", pa.int32()), ("n", pa.int64()), ("hi", pa.float64()), ("total", pa.float64())])
FOUND = pa.schema(
    [("src", pa.int64()), ("blk", pa.int64()), ("kind", pa.int32()), ("ms", pa.int64()), ("value", pa.float64()), ("reason", pa.string()), ("first_ms", pa.int64()), ("n", pa.int64()), ("open_left", pa.bool_()), ("open_right", pa.bool_()), ("run_ms", pa.list_(pa.int64()))]
)


def _windows(x: np.ndarray) -> np.ndarray:
    padded = np.pad(x, HALF, mode="reflect" if len(x) > HALF else "edge")
    return np.lib.stride_tricks.sliding_window_view(padded, 2 * HALF + 1)


def running_median(x: np.ndarray) -> np.ndarray:
    return np.partition(_windows(x), HALF, axis=1)[:, HALF]


def neighbours_median(x: np.ndarray) -> np.ndarray:
    """The same without the reading itself. It halves steps, so it only serves to tell the scale."""
    w = np.partition(np.delete(_windows(x), HALF, axis=1), (HALF - 1, HALF), axis=1)
    return (w[:, HALF - 1] + w[:, HALF]) / 2


def _half_differences(x: np.ndarray) -> np.ndarray:
    padded = np.pad(x, 1, mode="edge")
    return (padded[2:] - padded[:-2]) / 2


def outside_ellipsoids(u: np.ndarray, axes: tuple[float, float, float], angle: float, floor: float, rounds: int = ROUNDS) -> np.ndarray:
    """Mask of the points outside the ellipsoid of (u, its first and its second differences), found iteratively.

    ``axes`` are the extents in the three directions, ``angle`` the tilt in the plane of ``u`` and its second
    differences. Points found are replaced by no deviation before the next round.
    """
    bad, kept = np.zeros(len(u), bool), u.copy()
    s0, s1, s2 = axes
    c, s = np.cos(angle), np.sin(angle)
    spread = c**4 - s**4  # the rotated ellipse's axes follow from its extents s0 and s2
    a2, b2 = ((s0**2 * c**2 - s2**2 * s**2) / spread, (s2**2 * c**2 - s0**2 * s**2) / spread) if abs(spread) > 1e-6 else (0.0, 0.0)
    if min(a2, b2) <= 0:  # no ellipse of this tilt has these extents
        c, s, a2, b2 = 1.0, 0.0, s0**2, s2**2
    for _ in range(rounds):
        d1 = _half_differences(kept)
        d2 = _half_differences(d1)
        new = ((kept / s0) ** 2 + (d1 / s1) ** 2 > 1) | ((d1 / s1) ** 2 + (d2 / s2) ** 2 > 1) | ((kept * c + d2 * s) ** 2 / a2 + (d2 * c - kept * s) ** 2 / b2 > 1)
        new &= ~bad & (np.abs(u) > floor)
        if not new.any():
            break
        bad |= new
        kept[new] = 0.0
    return bad


def flat_links(v: np.ndarray, tol: float) -> np.ndarray:
    """Whether each reading belongs to one unchanging stretch with the one before.

    A stretch is made of overlapping windows of FLAT readings, none of them zero, that differ by ``2 * tol`` at most.
    """
    links = np.zeros(len(v), bool)
    if len(v) >= FLAT:
        w = np.lib.stride_tricks.sliding_window_view(v, FLAT)
        flat = (w.max(axis=1) - w.min(axis=1) <= 2 * tol + EPS) & (w != 0).all(axis=1)
        count = np.convolve(flat, np.ones(FLAT - 1, int))  # windows that cover both a reading and the one before
        links[1:] = count > 0
    return links


class _Source:
    """What is known of a source before its blocks are looked at; names as in the columns of ``_basics`` and ``_fit``."""

    def __init__(self, row: dict):
        self.step, self.all_active = row["step"] or 0.0, row["all_active"]
        self.floor = max(self.step, EPS)
        self.tol = row.get("tol") or 0.0
        self.axes = tuple(max(row[k] or 0.0, self.floor) * row["reach"] for k in ("s0", "s1", "s2")) if "s0" in row else None
        self.row = row


class _Block:
    """One block's readings and what follows from them alone."""

    def __init__(self, row: dict, source: _Source):
        self.src, self.blk = row["src"], row["blk"]
        self.ms, self.v, self.core = np.asarray(row["ms"], np.int64), np.asarray(row["v"], float), np.asarray(row["core"], bool)
        order = np.argsort(self.ms, kind="stable")
        self.ms, self.v, self.core = self.ms[order], self.v[order], self.core[order]
        self.u = self.v - running_median(self.v)
        self.active = np.ones(len(self.v), bool) if source.all_active else self.v != 0

    def phases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Deviations from the neighbours and their differences, which tell the scales."""
        around = self.v - neighbours_median(self.v)
        slope = _half_differences(around)
        return around, slope, _half_differences(slope)


def _histogram(src: int, kind: str, x: np.ndarray) -> list[tuple]:
    """Rows of STAT: counts of ``abs(x)`` in bins of equal ratio, with the greatest value of each."""
    x = np.abs(x)
    bins = np.full(len(x), -(2**20), np.int64)
    bins[x > 0] = np.floor(np.log2(x[x > 0]) * BINS).astype(np.int64)
    used, at, n = np.unique(bins, return_inverse=True, return_counts=True)
    hi = np.zeros(len(used))
    np.maximum.at(hi, at, x)
    return [(src, kind, int(b), int(c), float(h), None) for b, c, h in zip(used, n, hi, strict=True)]


def _first_look(b: _Block, s: _Source) -> list[tuple]:
    """Histograms of the raw readings, and how many neighbours are equal or within a step."""
    use = b.core & b.active
    pair = b.core[1:] & b.active[1:] & b.active[:-1]
    moves = np.abs(np.diff(b.v))[pair]
    out = [h for k, x in zip(("s0", "s1", "s2"), b.phases(), strict=True) for h in _histogram(b.src, k, x[use])] + _histogram(b.src, "move", moves)
    counts = {"pairs": len(moves), "same": int((moves <= EPS).sum()), "same_step": int((moves <= s.step + EPS).sum())}
    return out + [(b.src, k, 0, n, None, None) for k, n in counts.items()]


def _second_look(b: _Block, s: _Source) -> list[tuple]:
    """The same of the readings inside the first ellipsoids, with the moments of their tilt, sizes and signs."""
    bad = outside_ellipsoids(b.u, s.axes, 0.0, s.floor)
    good = b.core & b.active & ~bad
    out = [h for k, x in zip(("s0", "s1", "s2"), b.phases(), strict=True) for h in _histogram(b.src, k, x[good])] + _histogram(b.src, "size", b.v[good])
    kept = np.where(bad, 0.0, b.u)
    curve = _half_differences(_half_differences(kept))
    out += [(b.src, "uu", 0, None, None, float(np.sum(kept[good] ** 2))), (b.src, "uc", 0, None, None, float(np.sum(kept[good] * curve[good])))]
    return out + [(b.src, "negative", 0, int((b.core & (b.v < 0) & ~bad).sum()), None, None)]


def _judge(spike_sigmas: float, quiet_sigmas: float) -> Callable[[_Block, _Source], list[tuple]]:
    def judge(b: _Block, s: _Source) -> list[tuple]:
        """Rows of FOUND: kind 0 a flagged reading, kind 1 a run that touches the block's edge."""
        r = s.row
        bad = outside_ellipsoids(b.u, s.axes, r["angle"], s.floor)
        size, scale, top = np.abs(b.u), r["scale"], r["top"]
        settled = np.where(bad, b.v - b.u, b.v)
        w = _windows(settled)
        quiet = (w.max(axis=1) - w.min(axis=1) <= s.tol + EPS) & (_windows(bad.astype(float)).sum(axis=1) <= HALF)
        spike = np.zeros(len(b.v), bool)
        if scale is not None:
            spike = bad & (((size >= spike_sigmas * scale) & (scale > 0)) | (quiet & (size >= quiet_sigmas * scale) & (size > 1.5 * s.step)))
        impossible = np.zeros(len(b.v), bool)
        if top is not None:
            impossible |= np.abs(b.v) > 20 * max(top, s.step)
        if r["never_negative"]:
            impossible |= b.v < -max(3 * (scale or 0.0), 1.5 * s.step)
        out = [(b.src, b.blk, 0, int(b.ms[i]), float(b.v[i]), "impossible" if impossible[i] else "spike", None, None, None, None, None) for i in np.flatnonzero((spike | impossible) & b.core)]
        if r["longest"] is None:
            return out
        core = np.flatnonzero(b.core)
        first, last = int(core[0]), int(core[-1])
        links = flat_links(b.v, s.tol)
        after = np.append(links[1:], False)
        starts = [i for i in range(first, last + 1) if after[i] and (i == first or not links[i])] if (links | after)[first : last + 1].any() else []
        for a in starts + ([last] if links[last] and last == first and not after[last] else []):
            e = a
            while e < last and links[e + 1]:
                e += 1
            left, right = a == first and bool(links[a]), e == last and bool(after[e])
            if left or right:
                out.append((b.src, b.blk, 1, None, float(b.v[a]), None, int(b.ms[a]), e - a + 1, left, right, b.ms[a : e + 1].tolist()))
            elif e - a + 1 > r["longest"]:
                out += [(b.src, b.blk, 0, int(b.ms[i]), float(b.v[i]), "stuck", None, None, None, None, None) for i in range(a + 1, e + 1)]
        if last != first and links[first] and not after[first]:  # the end of a run of the block before
            out.append((b.src, b.blk, 1, None, float(b.v[first]), None, int(b.ms[first]), 1, True, False, [int(b.ms[first])]))
        return out

    return judge


def _over_blocks(look: Callable[[_Block, _Source], list[tuple]], schema: pa.Schema) -> Callable:
    """A pass over block rows that carry their source's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: (batch.column(n)[i].values.to_numpy(zero_copy_only=False) if n in ("ms", "v", "core") else batch.column(n)[i].as_py()) for n in batch.schema.names}
                source = _Source(row)
                rows += look(_Block(row, source), source)
            if len(rows) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (src, blk, ms, v, core) to one row per block; a block may span Arrow batches."""
    schema = pa.schema([("src", pa.int64()), ("blk", pa.int64()), ("ms", pa.list_(pa.int64())), ("v", pa.list_(pa.float64())), ("core", pa.list_(pa.bool_()))])
    held: list[tuple] = []

    def close() -> list[tuple]:
        src, blk = held[0][0], held[0][1]
        ms, v, core = (np.concatenate([h[k] for h in held]) for k in (2, 3, 4))
        held.clear()
        return [(src, blk, ms, v, core)] if core.any() else []

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    rows: list[tuple] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        src, blk, ms, v, core = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("src", "blk", "ms", "v", "core"))
        cuts = np.r_[0, np.flatnonzero((src[1:] != src[:-1]) | (blk[1:] != blk[:-1])) + 1, len(src)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and (held[0][0] != src[a] or held[0][1] != blk[a]):
                rows += close()
            held.append((int(src[a]), int(blk[a]), ms[a:b], v[a:b], core[a:b]))
        if len(rows) >= 16:
            yield emit(rows)
            rows = []
    if held:
        rows += close()
    if rows:
        yield emit(rows)


def _blocks(counts: DataFrame, block_rows: int, halo_rows: int) -> DataFrame:
    """(src, hour, target blocks) from the counts per source and hour: a small table, however large a source is."""
    w = Window.partitionBy("src").orderBy("hour")
    own = Window.partitionBy("src", "blk")
    at = (
        counts.withColumn("upto", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("before", F.col("upto") - F.col("n"))
        .withColumn("blk", F.floor(F.col("before") / F.lit(block_rows)).cast("long"))
        # block ids must follow each other so that neighbours can be told
        .withColumn("blk", F.dense_rank().over(Window.partitionBy("src").orderBy("blk")).cast("long"))
        .withColumn("first", F.min("before").over(own))
        .withColumn("end", F.max("upto").over(own))
    )
    target = lambda blk, core: F.struct(blk.alias("blk"), F.lit(core).alias("core"))
    near = lambda cond, t: F.when(cond, F.array(t)).otherwise(F.array().cast("array<struct<blk:bigint,core:boolean>>"))
    return at.select(
        "src",
        "hour",
        F.concat(
            F.array(target(F.col("blk"), True)),
            near(F.col("end") - F.col("upto") < halo_rows, target(F.col("blk") + 1, False)),
            near(F.col("before") - F.col("first") < halo_rows, target(F.col("blk") - 1, False)),
        ).alias("targets"),
    )


def _basics(kept: DataFrame) -> DataFrame:
    """Per source: readings, whether zeros are ordinary values of it, and the resolution of its values.

    ``step`` is the largest of 1, 0.1, ... 0.0001 of which nearly all values are multiples, else 0. Zeros are no values
    (switched off, dark) where they are more than 2 %.
    """
    x = F.col("v")
    multiple = lambda d: F.abs(x * 10**d - F.round(x * 10**d)) < 1e-6 * F.greatest(F.lit(1.0), F.abs(x * 10**d))
    counts = [F.count("*").alias("n"), F.count_if(x == 0).alias("n_zero"), F.count_if(x < 0).alias("n_below")]
    per = kept.groupBy("src").agg(*counts, *[F.count_if(multiple(d)).alias(f"m{d}") for d in range(5)])
    per = per.withColumn("all_active", F.col("n_zero") <= 0.02 * F.col("n"))
    off = F.when(F.col("all_active"), 0).otherwise(F.col("n_zero"))  # zeros are multiples of everything
    step = F.coalesce(*[F.when((F.col("n") > off) & (F.col(f"m{d}") - off >= 0.97 * (F.col("n") - off)), F.lit(10.0**-d)) for d in range(5)], F.lit(0.0))
    return per.select("src", "n", "all_active", step.alias("step"))


def _quantile(stats: DataFrame, kind: str, q: float) -> DataFrame:
    """(src, kind): the value that the share ``q`` of a histogram doesn't exceed."""
    own = stats.filter(F.col("kind") == kind)
    upto = F.sum("n").over(Window.partitionBy("src").orderBy("bin"))
    ranked = own.withColumn("upto", upto).withColumn("all", F.sum("n").over(Window.partitionBy("src")))
    return ranked.filter(F.col("upto") >= q * F.col("all")).groupBy("src").agg(F.min_by("hi", "bin").alias(kind), F.max("all").alias(f"n_{kind}"))


def _summed(blocks: DataFrame, sources: DataFrame, look) -> DataFrame:
    rows = blocks.join(sources, "src").mapInArrow(_over_blocks(look, STAT), STAT_DDL)
    return cut(rows.groupBy("src", "kind", "bin").agg(F.sum("n").alias("n"), F.max("hi").alias("hi"), F.sum("total").alias("total")))


def _axes(sources: DataFrame, stats: DataFrame) -> DataFrame:
    """Adds the robust scales of the three directions and the universal threshold."""
    for k in ("s0", "s1", "s2"):
        sources = sources.drop(k, f"n_{k}").join(_quantile(stats, k, 0.5), "src", "left").withColumn(k, 1.4826 * F.coalesce(k, F.lit(0.0)))
    return sources.withColumn("reach", F.sqrt(2 * F.log(F.greatest(F.col("n"), F.lit(3)).cast("double"))))


def _sum_of(stats: DataFrame, kind: str, column: str, name: str) -> DataFrame:
    return stats.filter(F.col("kind") == kind).select("src", F.col(column).alias(name))


def flag_implausible(
    rows: DataFrame,
    *,
    source: tuple[str, ...] = ("stream", "entity", "field"),
    instant: str = "timestamp_utc",
    value: str = "value",
    order: tuple[str, ...] = ("fetched_at_utc", "chunk", "row_id"),
    block_rows: int = 4096,
    halo_rows: int = 64,
    hour_ms: int = 3_600_000,
    spike_sigmas: float = 8.5,
    quiet_sigmas: float = 3.5,
    run_margin: float = 5.0,
) -> DataFrame:
    """Columns ``source``, ``ts_ms``, ``value``, ``reason`` (``spike``, ``impossible`` or ``stuck``), one row a reading.

    Of several copies of a reading (same source and millisecond) the first by ``order`` counts, also if its value is
    null. Null and NaN values and readings without instant are never flagged; nulls in the source's columns make a
    source of their own. A source with fewer than a dozen readings has no scale: only values of impossible
    size are found in it. Zeros never count as stuck (switched off, dark). An empty table gives an empty result; further columns are ignored.
    """
    slim = rows.select(key_hash(*source).alias("src"), *[F.col(c).alias(f"s_{i}") for i, c in enumerate(source)], epoch_ms(instant).alias("ms"), F.col(value).cast("double").alias("v"), *[F.col(c).alias(f"o_{i}") for i, c in enumerate(order)])
    slim = slim.filter("ms is not null").withColumn("hour", F.floor(F.col("ms") / hour_ms).cast("long"))
    names = slim.select("src", *[F.col(f"s_{i}").alias(c) for i, c in enumerate(source)]).distinct()  # one row per source: hashed without sorting
    best = slim.groupBy("src", "hour", "ms").agg(F.min_by("v", F.struct(*[f"o_{i}" for i in range(len(order))])).alias("v"))
    kept = store(best.filter("v is not null and not isnan(v) and abs(v) < 1e300"))
    counts = kept.groupBy("src", "hour").agg(F.count("*").alias("n"))
    placed = kept.join(_blocks(counts, block_rows, halo_rows), ["src", "hour"]).select("src", "ms", "v", F.explode("targets").alias("t")).select("src", "t.blk", "ms", "v", "t.core")
    blocks = store(placed.repartition("src", "blk").sortWithinPartitions("src", "blk", "ms").mapInArrow(_pack, BLOCK_DDL))

    sources = cut(_basics(kept))
    raw = _summed(blocks, sources, _first_look)
    for kind in ("pairs", "same", "same_step"):
        sources = sources.join(_sum_of(raw, kind, "n", kind), "src", "left")
    sources = _axes(sources.join(_quantile(raw, "move", 0.5), "src", "left"), raw)
    # readings within a step count as equal where the source usually moves by far more
    loose = (F.col("step") > 0) & (F.col("step") <= 0.25 * F.coalesce("move", F.lit(0.0)))
    p_same = F.greatest(F.coalesce(F.try_divide(F.when(loose, F.col("same_step")).otherwise(F.col("same")), F.col("pairs")), F.lit(1.0)), F.lit(1e-3))
    # n * (1 - p) runs that each go on with probability p: one longer than this comes by chance once in exp(margin) sources
    longest = F.greatest(F.lit(float(FLAT)), (F.log(F.greatest(F.col("n") * (1 - F.col("p_same")), F.lit(3.0))) + run_margin) / -F.log("p_same"))
    sources = cut(sources.withColumn("tol", F.when(loose, F.col("step")).otherwise(0.0)).withColumn("p_same", p_same).withColumn("longest", F.when(F.col("p_same") <= 0.9, longest)))

    inner = _summed(blocks, sources, _second_look)
    sources = _axes(sources, inner).join(_quantile(inner, "size", 0.95), "src", "left")
    for kind, column in (("uu", "total"), ("uc", "total"), ("negative", "n")):
        sources = sources.join(_sum_of(inner, kind, column, kind), "src", "left")
    enough = F.coalesce("n_s0", F.lit(0)) >= MIN_ACTIVE
    sources = cut(
        sources.withColumn("scale", F.when(enough, F.greatest("s0", F.when(F.col("p_same") > 0.9, 0.0).otherwise(F.col("step")))))
        .withColumn("top", F.col("size"))
        .withColumn("angle", F.atan(F.coalesce(F.try_divide(F.col("uc"), F.when(F.col("uu") > 0, F.col("uu"))), F.lit(0.0))))
        .withColumn("never_negative", F.coalesce(F.col("negative") < 0.01 * F.col("n"), F.lit(True)))
    )
    seen = cut(blocks.join(sources, "src").mapInArrow(_over_blocks(_judge(spike_sigmas, quiet_sigmas), FOUND), FOUND_DDL))

    w = Window.partitionBy("src").orderBy("blk", "first_ms")
    edges = seen.filter("kind = 1").select("src", "blk", "first_ms", "n", "open_left", "open_right")  # numbers only, two a block at most
    edges = edges.withColumn("joins", F.col("open_left") & F.coalesce(F.lag("open_right").over(w), F.lit(False))).withColumn("run", F.sum(F.when(F.col("joins"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    lengths = edges.groupBy("src", "run").agg(F.sum("n").alias("length"))
    long = edges.join(lengths, ["src", "run"]).join(sources.select("src", "longest"), "src").filter("length > longest").select("src", "blk", "first_ms", "joins")
    run_ms = F.when(F.col("joins"), F.col("run_ms")).otherwise(F.slice("run_ms", 2, F.greatest(F.size("run_ms") - 1, F.lit(0))))
    across = seen.filter("kind = 1").select("src", "blk", "first_ms", "run_ms", "value").join(long, ["src", "blk", "first_ms"]).select("src", F.explode(run_ms).alias("ts_ms"), "value", F.lit("stuck").alias("reason"))
    flagged = seen.filter("kind = 0").select("src", F.col("ms").alias("ts_ms"), "value", "reason").unionByName(across)
    return flagged.groupBy("src", "ts_ms").agg(F.first("value").alias("value"), F.min("reason").alias("reason")).join(names, "src").select(*source, "ts_ms", "value", "reason")

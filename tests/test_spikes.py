import math
import random
from datetime import datetime, timedelta, timezone

import numpy as np

from pulsegrid.operators import spikes
from pulsegrid.operators.spikes import flag_implausible

START = datetime(2026, 1, 5, tzinfo=timezone.utc)
SCHEMA = "row_id long, timestamp_utc timestamp, stream string, entity string, field string, value double, fetched_at_utc timestamp, chunk string, unit string, src long, blk string"


def series(entity, values, step=300, first_id=0):
    """Readings every ``step`` seconds, with columns that clash with internal names."""
    at = [START + timedelta(seconds=step * i) for i in range(len(values))]
    return [(first_id + i, t, "s", entity, "value", v, t + timedelta(seconds=9), f"c{i:06d}", None, 1, "x") for i, (t, v) in enumerate(zip(at, values, strict=True))]


def noisy(n, level=100.0, noise=1.0, seed=1):
    r = random.Random(seed)
    return [round(level + 5 * math.sin(i / 40) + r.gauss(0, noise), 2) for i in range(n)]


def flagged(spark, rows, **kw):
    out = flag_implausible(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    index = lambda r: round((r.ts_ms / 1000 - START.timestamp()) / 300)
    return {(r.entity, index(r)): r.reason for r in out}


def faulty():
    v = noisy(1200)
    v[200] = 160.0
    v[300:303] = [v[299] * 10, v[299] * 10.1, v[299] * 9.9]
    v[400] = -v[400]
    v[500] = 9999.0
    v[600:625] = [v[600]] * 25
    return v, {200, 300, 301, 302, 400, 500} | set(range(601, 625))


def test_spikes_impossible_and_stuck(spark):
    v, expected = faulty()
    found = flagged(spark, series("a", v))
    assert {i for _, i in found} == expected
    assert found["a", 500] == "impossible" and found["a", 200] == "spike" and found["a", 610] == "stuck"


def test_blocks_do_not_change_the_result(spark):
    v, expected = faulty()
    for block in (64, 300):
        assert {i for _, i in flagged(spark, series("a", v), block_rows=block, halo_rows=40)} == expected


def test_what_is_normal_stays(spark):
    steps = noisy(400) + [round(x + 60, 2) for x in noisy(400, seed=2)]
    on_off = [0.0] * 100 + noisy(200, seed=3) + [0.0] * 80 + noisy(200, seed=4) + [0.0] * 60
    constant = [46.3] * 400 + [45.0] * 300
    rows = series("steps", steps) + series("on_off", on_off, first_id=10_000) + series("constant", constant, first_id=20_000)
    assert flagged(spark, rows) == {}


def test_departures_from_a_constant_and_from_darkness(spark):
    constant = [46.3] * 300
    constant[100:102] = [18.5, 19.0]
    sun = ([0.0] * 140 + [round(20 * math.sin(math.pi * i / 140) + random.Random(i).gauss(0, 0.5), 2) for i in range(1, 140)]) * 4
    sun[60] = 6.0
    found = flagged(spark, series("constant", constant) + series("sun", sun, first_id=5_000))
    assert set(found) == {("constant", 100), ("constant", 101), ("sun", 60)}


def test_the_copy_fetched_first_counts(spark):
    rows = series("a", noisy(300))
    late = list(rows[50])
    late[0], late[5], late[6] = 9_000, 9999.0, late[6] + timedelta(hours=1)
    assert flagged(spark, [*rows, tuple(late)]) == {}
    late[6] = rows[50][6] - timedelta(seconds=5)
    assert set(flagged(spark, [*rows, tuple(late)])) == {("a", 50)}


def test_nulls_nan_few_rows_and_empty(spark):
    v = noisy(300)
    v[10], v[20] = None, float("nan")
    rows = series("a", v) + series(None, noisy(3, seed=7), first_id=1000) + series("few", [1.0, 5.0, 1.0], first_id=2000) + series("huge", [1.0, 1e9, 1.0], first_id=3000)
    rows.append((5000, None, None, None, None, None, None, None, None, None, None))
    assert flagged(spark, rows) == {("huge", 1): "impossible"}
    assert flag_implausible(spark.createDataFrame([], SCHEMA)).count() == 0


def test_running_median_and_ellipsoid():
    x = np.array([1.0, 2, 3, 100, 5, 6, 7, 8, 9, 10, 11, 12])
    assert spikes.running_median(x)[5] == np.median(x[:11])
    u = np.random.RandomState(0).normal(0, 1, 500)
    u[250] = 30
    d1 = spikes._half_differences(u)
    scales = [1.4826 * np.median(np.abs(x)) * np.sqrt(2 * np.log(500)) for x in (u, d1, spikes._half_differences(d1))]
    for angle in (0.0, -0.3):
        bad = spikes.outside_ellipsoids(u, tuple(scales), angle, 0.01)
        assert bad[250] and bad.mean() < 0.1


def test_flat_stretches():
    v = np.array([1.0, 5.0, 5.01, 5.0, 5.0, 5.0, 5.0, 5.0, 5.0, 5.01, 9.0] + [0.0] * 9)
    assert np.flatnonzero(spikes.flat_links(v, 0.01)).tolist() == list(range(2, 10))
    assert np.flatnonzero(spikes.flat_links(v, 0.0)).tolist() == [] and not spikes.flat_links(v[:3], 1.0).any()


def test_resolution_and_histograms(spark):
    kept = spark.createDataFrame([(k, v) for k, vs in ((1, [1.5, 2.5, 3.1]), (2, [1.0, 2.0, 0.0]), (3, [1 / 3, 2 / 3]), (4, [0.0, 0.0])) for v in vs], "src long, v double")
    assert {r.src: (r.step, r.all_active) for r in spikes._basics(kept).collect()} == {1: (0.1, True), 2: (1.0, False), 3: (0.0, True), 4: (0.0, False)}
    x = np.abs(np.random.RandomState(1).lognormal(0, 2, 999))
    parts = [h for p in np.array_split(x, 7) for h in spikes._histogram(5, "s0", p)]
    stats = spark.createDataFrame(parts, spikes.STAT_DDL).groupBy("src", "kind", "bin").sum("n").withColumnRenamed("sum(n)", "n")
    whole = spark.createDataFrame(spikes._histogram(5, "s0", x), spikes.STAT_DDL)
    assert {tuple(r) for r in stats.collect()} == {(r.src, r.kind, r.bin, r.n) for r in whole.collect()}
    assert abs(spikes._quantile(whole, "s0", 0.5).first().s0 / np.median(x) - 1) < 0.05


def test_runs_across_blocks(spark):
    v = noisy(700, seed=11)
    for a, n in ((60, 20), (250, 190), (511, 30), (640, 4)):
        v[a : a + n] = [v[a]] * n
    expected = set(range(61, 80)) | set(range(251, 440)) | set(range(512, 541))
    for block in (32, 64, 100, 4096):
        found = flagged(spark, series("a", v), block_rows=block)
        assert {i for (_, i), r in found.items() if r == "stuck"} == expected


def test_the_cuts_do_not_matter_on_real_tables(spark, data):
    rows = spark.read.parquet(f"{data}/snapshot_rows.parquet")
    first, *others = [{tuple(r) for r in flag_implausible(rows, block_rows=b).collect()} for b in (64, 256, 4096)]
    assert first and all(o == first for o in others)


def test_planted_faults_of_many_kinds_of_sources(spark):
    """Faults planted in made-up sources that no threshold was set on: another noise, level, rate and course."""
    r = np.random.RandomState(77)
    rows, expected = [], set()
    for k in range(8):
        n, level, noise = 1500, 10.0 ** r.randint(0, 4), 10.0 ** r.uniform(-2, 0)
        v = level * (5 + np.sin(np.arange(n) / r.uniform(50, 200)) + 0.01 * noise * r.standard_t(6, n).cumsum() * 0.1 + 0.02 * r.standard_normal(n))
        v = np.round(v, 3)
        for at in r.choice(np.arange(20, n - 60, 40), 12, replace=False):
            kind = r.randint(3)
            if kind == 0:
                v[at : at + r.randint(1, 4)] += level * r.choice([-1, 1]) * r.uniform(1.5, 3)
            elif kind == 1:
                v[at] = -v[at]
            else:
                v[at] = level * 500
        expected |= {(f"e{k}", int(i)) for i in np.flatnonzero((v < 0) | (v > level * 100))}
        rows += series(f"e{k}", v.tolist(), first_id=k * 10_000)
    found = flagged(spark, rows)
    sure = {x for x in found if x in expected}
    assert len(sure) >= 0.99 * len(expected) and len(found) < 12 * 8 * 4

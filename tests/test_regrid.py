import random
from datetime import datetime, timedelta, timezone

from helpers import rows
from pyspark.sql import functions as F

from pulsegrid.operators.ordering import every_cell, exact_quantiles, with_previous
from pulsegrid.operators.regrid import counter_on_grid, on_grid, uncovered_cells

T0 = datetime(2026, 1, 5, tzinfo=timezone.utc)


def test_uncovered_cells_against_brute_force(spark):
    r = random.Random(5)
    data = [(e, r.randrange(-50, 300), r.random() < 0.6) for e in ("a", "b", None) for _ in range(200)]
    found = uncovered_cells(spark.createDataFrame(data, "entity string, cell long, covered boolean"), ("entity",), span=32)
    expected = []
    for e in ("a", "b", None):
        own = [(c, v) for x, c, v in data if x == e]
        held = {c for c, v in own if v}
        expected += [(e, c) for c in range(min(c for c, _ in own), max(c for c, _ in own) + 1) if c not in held]
    assert rows(found) == sorted(expected, key=lambda t: (t[0] is None, t[0] or "", t[1]))


def test_on_grid_marks_and_averages(spark):
    data = [("a", 0, 1.0), ("a", 0, 3.0), ("a", 3, 5.0), ("a", 5, None), ("a", None, 9.0), ("b", 7, float("nan"))]
    grid = on_grid(spark.createDataFrame(data, "entity string, m long, value double"), ("entity",), F.col("m"), "value")
    assert rows(grid) == [("a", 0, 2.0, 2, False), ("a", 1, None, 0, True), ("a", 2, None, 0, True), ("a", 3, 5.0, 1, False), ("a", 4, None, 0, True), ("a", 5, None, 0, True), ("b", 7, None, 0, True)]
    assert on_grid(spark.createDataFrame([], "entity string, m long, value double"), ("entity",), F.col("m"), "value").count() == 0


def reading(s, v):
    return ("m", T0 + timedelta(seconds=s), v)


def test_counters_share_increments_and_detect_resets(spark):
    data = [reading(30, 100.0), reading(90, 160.0), reading(150, 10.0), reading(150, None), reading(600, 20.0), reading(660, 50.0), reading(660, 40.0)]
    df = spark.createDataFrame(data, "entity string, t timestamp, v double")
    base = int(T0.timestamp()) // 60
    found = {r.cell - base: (r.value, r.covered_ms, r.is_missing) for r in counter_on_grid(df, ("entity",), "t", "v", width_ms=60_000, max_gap_ms=120_000, span=4).collect()}
    assert found[0] == (30.0, 30_000, False)
    assert found[1] == (30.0 + 5.0, 60_000, False)  # the counter fell to 10: it began again at 0
    assert found[2] == (5.0, 30_000, False)
    assert all(found[k] == (None, 0, True) for k in range(3, 10))
    assert found[10] == (30.0, 60_000, False)
    whole = counter_on_grid(df, ("entity",), "t", "v", width_ms=60_000).collect()
    assert abs(sum(r.value for r in whole) - (60 + 10 + 10 + 30)) < 1e-9 and not any(r.is_missing for r in whole)


def test_previous_across_blocks(spark):
    r = random.Random(2)
    data = [(k, i, r.random()) for k in ("a", None) for i in sorted(r.sample(range(1000), 60))]
    out = with_previous(spark.createDataFrame(data, "k string, i long, v double"), ("k",), F.floor(F.col("i") / 50), ("i",), "v", "before")
    expected = {}
    for k in ("a", None):
        own = [d for d in data if d[0] == k]
        expected |= {(k, b[1]): a[2] for a, b in zip(own, own[1:])} | {(k, own[0][1]): None}
    assert {(x.k, x.i): x.before for x in out.collect()} == expected


def test_exact_quantiles(spark):
    r = random.Random(6)
    data = [(k, r.choice([0.0, -2.5, 1e-9, r.lognormvariate(0, 3), -r.random()])) for k in ("a", None) for _ in range(300)] + [("one", 7.0), ("a", None), ("a", float("nan")), ("none", None)]
    got = {x.k: (x.m, x.p) for x in exact_quantiles(spark.createDataFrame(data, "k string, v double"), ("k",), "v", {"m": 0.5, "p": 0.99}).collect()}

    def plain(k, q):
        own = sorted(v for x, v in data if x == k and v is not None and v == v)
        at = (len(own) - 1) * q
        return own[int(at)] + (own[min(int(at) + 1, len(own) - 1)] - own[int(at)]) * (at - int(at))

    assert got.keys() == {"a", None, "one"} and all(abs(g - plain(k, q)) < 1e-12 for k, pair in got.items() for g, q in zip(pair, (0.5, 0.99)))


def test_every_cell(spark):
    bounds = spark.createDataFrame([("a", -3, 9), (None, 5, 5), ("none", 4, 3)], "k string, lo long, hi long")
    assert rows(every_cell(bounds, ("k",), "lo", "hi", span=4)) == [*(("a", c) for c in range(-3, 10)), (None, 5)]

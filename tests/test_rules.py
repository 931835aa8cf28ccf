from datetime import datetime, timedelta, timezone

from helpers import rows
from pyspark.sql import functions as F

from pulsegrid.operators import coverage as cov
from pulsegrid.operators.dedupe import first_per_key, latest_per_key, span_per_version, upsert_rows
from pulsegrid.operators.drift import new_kinds, upsert_drift_log
from pulsegrid.operators.monitor import alert_actions, alerts, capture_alerts, latest_chunk, recovered
from pulsegrid.operators.views import hourly_means

NOW = datetime(2026, 9, 30, 12, tzinfo=timezone.utc)


def polls(spark, minutes, failed=(), n_ok=6):
    data = [(f"c{i}", NOW - timedelta(minutes=m), "snap", n_ok, 6, list(failed)) for i, m in enumerate(minutes)]
    return spark.createDataFrame(data, "chunk string, started_utc timestamp, kind string, n_ok int, n int, failed array<string>")


def fired(df):
    return {r.alert for r in alerts(df, F.lit(NOW)).collect()}


def test_monitor_rules(spark):
    assert fired(polls(spark, [10, 300])) == {"snapshot-cadence"}
    assert fired(polls(spark, range(0, 720, 5))) == set()
    assert fired(polls(spark, range(0, 720, 5), failed=["sin"])) == {"sin-stale", "endpoint-failing-sin"}
    assert fired(polls(spark, [])) == {"snapshot-stale", "sin-stale", "snapshot-cadence"}
    assert fired(polls(spark, range(400, 720, 5))) == {"snapshot-stale", "sin-stale", "snapshot-cadence"}
    assert rows(recovered(polls(spark, [5]), F.lit(NOW))) == [("blocked",), ("fetch-failing",)] and recovered(polls(spark, [5], n_ok=5), F.lit(NOW)).count() == 0


def test_drift_log_upsert(spark):
    schema = "endpoint string, path string, kind string, pattern string, severity string, example string, first_seen_chunk string, last_seen_chunk string, n_chunks string"
    log = spark.createDataFrame([("e", "p", "k", "#", "WARN", "old", "c1", "c2", "3"), ("e", None, "k", "#", "WARN", "x", "c1", "c1", "nan")], schema)
    rollup = spark.createDataFrame([("e", "p", "k", "#", "ERROR", "new", "c3", "c4", "2"), ("e", None, "k", "#", "WARN", "y", "c0", "c5", "1"), ("e", "q", "irregular_step", "#", "WARN", "y", "c3", "c3", "1"), ("e", "q", "k", "#", "WARN", "y", "c3", "c3", "1")], schema)
    assert rows(upsert_drift_log(log, rollup), "path", "kind", "severity", "example", "first_seen_chunk", "last_seen_chunk", "n_chunks") == [
        ("p", "k", "WARN", "old", "c1", "c4", 5), ("q", "irregular_step", "WARN", "y", "c3", "c3", 1), ("q", "k", "WARN", "y", "c3", "c3", 1), (None, "k", "WARN", "x", "c1", "c5", 1)]
    assert rows(new_kinds(log, rollup, ("irregular_step",)), "path", "kind") == [("q", "k")]


def test_keyed_dedupe_with_nulls_and_ties(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("a", None, "w"), (None, None, None), (None, 5, "q")], "k string, o int, v string")
    assert rows(first_per_key(df, ("k",), ("o",))) == [("a", 1, "y"), (None, 5, "q")]
    assert rows(latest_per_key(df, ("k",), ("o",))) == [("a", 2, "x"), (None, 5, "q")]
    assert rows(upsert_rows(df.filter("o = 2"), df, ("k",), ("o",))) == [("a", 2, "x"), (None, 5, "q")]
    spans = spark.createDataFrame([("a", 1.0, None, 5, 6), ("a", 1.0, "MW", 7, 9), ("a", None, "MW", 1, None)], "k string, v double, unit string, f int, l int")
    assert rows(span_per_version(spans, ("k", "v"), "f", "l")) == [("a", 1.0, "MW", 5, 9), ("a", None, "MW", 1, None)]
    assert first_per_key(df.limit(0), ("k",), ("o",)).count() == 0


def test_islands_across_blocks(spark):
    cells = [0, 1, 2, 3, 4, 5, 9, 10, 20, 20, -3, -2]
    df = spark.createDataFrame([(c, k) for c in cells for k in ("a", None)], "cell long, k string")
    expected = [(-3, -2, 2), (0, 5, 6), (9, 10, 2), (20, 20, 1)]
    assert rows(cov.intervals(df.filter("k = 'a'"), block=4), "start_cell", "end_cell", "n_cells") == expected
    assert rows(cov.intervals(df, ("k",), block=3).filter("k is null"), "start_cell", "end_cell", "n_cells") == expected
    assert cov.intervals(df.limit(0)).count() == 0


def test_coverage_without_complete_minutes_is_empty(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "entity string, cell long")
    assert cov.grid(df, "entity", F.col("cell")).count() == 0 and cov.grid(df.limit(0), "entity", F.col("cell")).count() == 0
    assert rows(cov.grid(df, "entity", F.col("cell"), since=1, until=3)) == [(1, False), (2, False), (3, False)]


def test_hourly_means_keep_empty_hours(spark):
    df = spark.createDataFrame([("a", datetime(2026, 1, 1, 0, 5), 1.0), ("a", datetime(2026, 1, 1, 0, 50), 3.0), ("a", datetime(2026, 1, 1, 2, 0), 9.0), (None, datetime(2026, 1, 1), 1.0)], "entity string, timestamp_utc timestamp, value double")
    assert rows(hourly_means(df)) == [("a", datetime(2026, 1, 1, 0), 2.0), ("a", datetime(2026, 1, 1, 1), None), ("a", datetime(2026, 1, 1, 2), 9.0)]


def test_alert_state(spark):
    at = lambda h: NOW - timedelta(hours=h)
    firing = spark.createDataFrame([("new",), ("old",), ("old",), ("recent",), (None,)], "alert string")
    held = spark.createDataFrame([("old", at(13)), ("recent", at(2)), ("gone", at(1)), ("stays", at(1))], "alert string, updated_utc timestamp")
    solved = spark.createDataFrame([("gone",), ("recent",), ("never open",)], "alert string")
    assert rows(alert_actions(firing, held, solved, F.lit(NOW))) == [("gone", "close"), ("new", "open"), ("old", "repeat"), ("recent", "none"), (None, "open")]


def test_capture_alerts(spark):
    schema = "chunk string, kind string, endpoint string, status double, ok boolean, error string"
    data = [("a", "snap", "sin", 403.0, False, None), ("a", "snap", "gen", 200.0, True, None), ("b", "snap", "sin", 503.0, False, "Cloudflare challenge"), ("c", "trend", "sin", None, None, None), ("d", "snap", "sin", 503.0, True, "x")]
    assert rows(capture_alerts(spark.createDataFrame(data, schema))) == [("a", "blocked"), ("b", "blocked"), ("b", "fetch-failing"), ("c", "trend-capture-failing")]
    assert rows(latest_chunk(polls(spark, [10, 300]))) == [((NOW - timedelta(minutes=10)).replace(tzinfo=None),)] and latest_chunk(polls(spark, [])).first()[0] is None


def test_report_of_completeness(spark):
    start = datetime(2026, 1, 5)
    label = lambda m: start + timedelta(minutes=m)
    data = [(e, label(m), label(m), 1.0, label(m), label(m)) for e in ("a", "b") for m in range(0, 240, 2)] + [("a", label(1), label(1), 2.0, label(1), label(1)), ("a", label(0), label(0), 9.0, label(0), label(0))]
    df = spark.createDataFrame(data, "entity string, timestamp_utc timestamp, minute_label_local timestamp_ntz, value double, first_seen_update_utc timestamp, last_seen_update_utc timestamp")
    days = cov.cadence(spark.createDataFrame([(start + timedelta(days=d),) for d in range(40)], "t timestamp"), "t")
    text = cov.report(df, "entity", cov.label_minute("minute_label_local"), "timestamp_utc", df, days)
    assert "minutes expected 239, held 120, missing 119" in text and "and 69 more" in text and "2026-01-05 00:01 to 2026-01-05 00:01 local, 1 min" in text
    assert "revised a: 1 of 121 samples" in text and "2026-01-14:" in text and "2026-01-13:" not in text
    assert cov.report(df.limit(0), "entity", cov.label_minute("minute_label_local"), "timestamp_utc", df, days) == "No trend data."

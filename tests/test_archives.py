from datetime import datetime, timezone

import pytest
from helpers import make_chunk, rows
from pyspark.sql import functions as F

from pulsegrid.functions import timeparse as tp
from pulsegrid.functions.values import number_of, text_beside
from pulsegrid.operators import coverage as cov
from pulsegrid.operators.drift import drift_events, drift_rollup
from pulsegrid.operators.explode import snapshot_rows
from pulsegrid.operators.export import export_all, write_manifests
from pulsegrid.operators.merge import digest, merge_log, merge_trend, read_log
from pulsegrid.operators.trend import trend_rows
from pulsegrid.operators.verify import minute_agreement, missing_minutes, same_instant, verdict, window_of
from pulsegrid.operators.views import canonical, minute_means
from pulsegrid.schema import DRIFT_EVENTS, FETCH_LOG, LEDGER, PROBES, SNAPSHOT, TREND
from pulsegrid.sources.archives import between_days, bodies, discover, fetch_results, load_members, of_month, pending, probe_results, release_day, unreadable
from pulsegrid.streaming.ingest import consolidate, drift_log, hourly_stream, ingest_files, observed_versions, stream_archives

UPDATE = "29-septiembre-2026 5:23:53"


def trend(n=1441, end=(8, 29, 5, 23), value=lambda i, j: str(1000 + i + j), names=("Generación", "Demanda Real", "Demanda Pronosticada")):
    month, day, hour, minute = end
    last = datetime(2026, month + 1, day, hour, minute)
    points = []
    for k in range(n):
        t = datetime.fromtimestamp(last.timestamp() - 60 * (n - 1 - k))
        points.append({"value": [value(k, j) for j in range(3)], "time": {"y": str(t.year), "m": str(t.month - 1), "d": str(t.day), "h": str(t.hour), "mi": str(t.minute)}})
    return {"names": list(names), "series": points}


def clean():
    return {
        "sin": {"update": UPDATE, "data": [{"name": "Carga", "value": "1345.5", "engunit": "MW"}], "max": [{"date": "x", "value": "1", "engunit": "MW"}], "water": [{"name": "L", "value": "1", "hi": "2", "lo": "0", "cu": "3%", "cl": "4%", "color": "r"}], "trend": trend()},
        "gen": {"update": UPDATE, "pie": [{"name": "Hídrica 1062.14 (75.84%)", "value": "1062.14", "color": "b"}], "pie2": [{"name": "X 1 (2%)", "value": "1", "color": "b"}], "unit": [{"name": "Bayo 1", "value": "80", "color": "v"}]},
        "vert": {
            "update": UPDATE, "flow": [{"name": "F", "value": "1", "engunit": "m3/s"}],
            "plant": [{"name": "P", "color": "", "nactual": "1", "cotamax": "2", "vert": None, "cons": "75%", "mwactual": "3", "agente": "A", "contrato": "4"}, {"Total": "99.5"}],
            "solar": [{"name": "S", "lic": "1", "mwactual": "2", "agente": "A"}, {"Total": "2"}], "eolica": [{"name": "E", "lic": "1", "mwactual": "2", "agente": "A"}], "final": "1,040.82",
        },
        "int": {"update": UPDATE, "nodes": [{"from": {"name": " A ", "mw": "1", "mvar": "2"}, "to": {"name": "", "mw": "-1", "mvar": "-2"}}]},
        "diagram": {"update": UPDATE, **{k: [{"tag": "X_MW.AV", "name": "n", "value": "5.5", "color": "c", "timestamp": "2026-09-29 05:23:54.117"}] for k in ("units", "tooltips")}},
        "flow": {"update": UPDATE, "occi": [{"value": str(i)} for i in range(7)], "msg": {"name": "m", "description": "d", "style": "s"}},
    }


NAME = "poll_20260929T102400Z_snap_ok6of6.tar.gz"


def load(spark, folder):
    return bodies(load_members(spark, str(folder)))


@pytest.fixture
def raw(spark, tmp_path):
    make_chunk(tmp_path, NAME, clean())
    return load(spark, tmp_path)


def test_a_clean_poll_has_no_drift(raw):
    assert rows(drift_events(raw)) == []


def test_parsed_values(raw):
    got = {(r.stream, r.entity, r.field): r for r in snapshot_rows(raw).collect()}
    value = lambda *k: (got[k].value, got[k].value_text, got[k].unit)
    assert value("vert.final", "final", "value") == (1040.82, "1,040.82", "MW")
    assert value("gen.pie", "Hídrica", "value") == (1062.14, None, "MW") and value("gen.pie", "Hídrica", "share_pct") == (75.84, None, "%")
    assert value("vert.plant", "P", "cons") == (75.0, "75%", None) and value("vert.plant", "Total", "value") == (99.5, None, "MW")
    assert value("vert.plant", "P", "color") == (None, "", None) and ("vert.plant", "P", "vert") not in got
    assert value("int.nodes", "A -> ", "from_mw") == (1.0, None, "MW") and value("int.nodes", "A -> ", "to_mvar") == (-2.0, None, "MVAr")
    assert value("sin.data", "Carga", "value") == (1345.5, None, "MW") and value("sin.max", "SIN", "date") == (None, "x", None)
    assert value("flow.occi", "occi[6]", "value") == (6.0, None, "MW") and value("flow.msg", "msg", "style") == (None, "s", None)
    tag = got["diagram.units", "X_MW.AV", "value"]
    assert tag.unit == "MW" and tag.timestamp_local == datetime(2026, 9, 29, 5, 23, 54, 117000) and ("diagram.units", "X_MW.AV", "timestamp") not in got
    at = got["gen.unit", "Bayo 1", "value"]
    assert at.timestamp_local == datetime(2026, 9, 29, 5, 23, 53) and at.timestamp_utc == at.source_update_utc == datetime(2026, 9, 29, 10, 23, 53) and at.chunk == NAME


def test_trend_golden_values(raw):
    out = trend_rows(raw)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TREND] and out.count() == 1441 * 3
    last = out.orderBy(F.desc("timestamp_utc")).first()
    assert last.timestamp_local == datetime(2026, 9, 29, 5, 23, 53) and last.minute_label_local == datetime(2026, 9, 29, 5, 23)


def kinds(df):
    return {(r.path, r.kind, r.severity) for r in drift_events(df).collect()}


def test_drift_kinds_and_the_rest_survives(spark, tmp_path):
    b = clean()
    del b["gen"]["pie2"]
    b["gen"]["unit"] = [{"nombre": "U", "value": "1", "color": "v"}]
    b["gen"]["nuevo"] = [{"name": "q", "z": 1}]
    b["gen"]["pie"][0]["name"] = "no label"
    b["vert"] = '{"update": "29-sept'
    b["sin"]["update"] = "yesterday"
    b["int"]["nodes"] = {"a": 1}
    b["diagram"]["units"][0]["timestamp"] = "2026-13-01 00:00:00"
    make_chunk(tmp_path, NAME, b)
    make_chunk(tmp_path, "poll_20260929T102900Z_snap_ok6of6.tar.gz", {}, broken=True)
    df = load(spark, tmp_path)
    assert kinds(df) >= {
        ("pie2", "missing_key", "ERROR"), ("gen.unit", "missing_field", "WARN"), ("gen.unit", "new_field", "WARN"), ("gen.unit", "missing_entity_key", "ERROR"), ("nuevo", "new_key", "WARN"),
        ("gen.pie", "label_format", "WARN"), ("$", "invalid_json", "ERROR"), ("update", "bad_timestamp", "ERROR"), ("int.nodes", "type_change", "ERROR"), ("diagram.units", "bad_timestamp", "WARN"),
    }
    got = {(r.stream, r.entity, r.field): r for r in snapshot_rows(df).collect()}
    assert got["gen.nuevo", "q", "z"].value == 1 and got["gen.unit", "#0", "nombre"].value_text == "U" and got["flow.occi", "occi[0]", "value"].value == 0
    assert got["sin.data", "Carga", "value"].timestamp_utc == datetime(2026, 9, 29, 10, 24) and got["sin.data", "Carga", "value"].source_update_utc is None
    assert rows(unreadable(load_members(spark, str(tmp_path))), "kind", "path") == [("chunk_unreadable", "poll_20260929T102900Z_snap_ok6of6.tar.gz")]
    assert drift_rollup(drift_events(df)).filter("kind = 'missing_field'").select("pattern").first()[0] == "'name' missing in #/# records"


def test_trend_conventions(spark, tmp_path):
    one = clean()["sin"]
    for p in one["trend"]["series"]:
        p["time"]["m"] = str(int(p["time"]["m"]) + 1)
    blank = clean()["sin"]
    for p in blank["trend"]["series"][:10]:
        p["value"][2] = ""
    del blank["trend"]["series"][20:80]
    blank["trend"]["series"][5]["value"][0] = "abc"
    make_chunk(tmp_path / "one", NAME, {"sin": one})
    make_chunk(tmp_path / "blank", NAME, {"sin": blank})
    a, b = load(spark, tmp_path / "one"), load(spark, tmp_path / "blank")
    assert ("trend.series.time", "month_indexing_changed", "ERROR") in kinds(a) and trend_rows(a).agg(F.max("timestamp_utc")).first()[0] == datetime(2026, 9, 29, 10, 23, 53)
    events = {r.kind: r.detail for r in drift_events(b).collect()}
    assert events == {"bad_value": "1 unparseable points/values of 1381", "empty_values": "10 empty values of 1381 points", "irregular_step": "1 steps != 1 minute", "length_change": "1381 points (was 1441)"}
    samples = trend_rows(b).filter("entity = 'Generación'")
    window = cov.grid(samples, "entity", F.floor(F.unix_micros(F.col("minute_label_local").cast("timestamp")) / 60_000_000).cast("long"))
    gaps = cov.intervals(window.filter("not is_held")).orderBy("start_cell").collect()
    assert [g.n_cells for g in gaps] == [1, 60]
    assert abs(cov.coverage_summary(window).first().completeness - 1380 / 1441) < 1e-9


def test_ingest_is_idempotent_and_revisions_are_kept(spark, tmp_path):
    a = {"sin": clean()["sin"], "gen": clean()["gen"]}
    later = {"sin": {"update": "29-septiembre-2026 5:24:53", "data": [], "trend": trend(end=(8, 29, 5, 24), value=lambda i, j: str(1001 + i + j) if (i, j) != (100, 0) else "7")}, "gen": clean()["gen"]}
    make_chunk(tmp_path / "in", NAME, a, probes={"dead": {"status": 200, "fetched_at_utc": "x"}})
    make_chunk(tmp_path / "in", "poll_20260929T102500Z_snap_ok2of2.tar.gz", later, fetched="2026-09-29T10:25:00+00:00")
    make_chunk(tmp_path / "in", "poll_20260929T103000Z_snap_ok2of2.tar.gz", {}, broken=True)
    files = spark.read.format("binaryFile").load(f"{tmp_path}/in")
    store = f"{tmp_path}/store"
    first = ingest_files(files, store)
    assert first.snapshots and first.trend and rows(first.ledger, "chunk", "snapshot_rows")[2][1] == "0"
    again = ingest_files(files, store)
    assert again.snapshots == [] and again.trend == []
    trend_store, snaps = spark.read.schema(TREND).parquet(f"{store}/trend"), spark.read.schema(SNAPSHOT).parquet(f"{store}/snapshots")
    assert trend_store.select("entity", "timestamp_utc").distinct().count() == 1442 * 3
    assert rows(snaps.filter("stream = 'gen.unit'").select("chunk").distinct()) == [(NAME,)]  # the generation seen twice is kept once
    revised = canonical(trend_store).filter("value = 7").collect()
    assert len(revised) == 1 and trend_store.count() == 1442 * 3 + 1
    assert minute_means(canonical(trend_store)).count() == 1442 * 3
    assert cov.revision_stats(trend_store, "entity", "timestamp_utc").agg(F.sum("n_revised")).first()[0] == 1
    assert rows(probe_results(load_members(spark, f"{tmp_path}/in"))) == [(NAME, "dead", "200", "x")]
    assert fetch_results(load_members(spark, f"{tmp_path}/in")).count() == 4
    assert read_log(spark, f"{store}/fetch_log", FETCH_LOG).count() == 4 and read_log(spark, f"{store}/ledger", LEDGER).count() == 3

    fresh = trend_rows(load(spark, tmp_path / "in").filter("chunk like '%102500Z%'"))
    window = window_of(fresh, trend_store)
    agree, exact, missing = minute_agreement(window, minute_means(canonical(trend_store))), same_instant(window, canonical(trend_store)), missing_minutes(window, trend_store, 3)
    assert verdict(missing, agree, exact, ("Generación", "Demanda Real"), "Generación")
    wrong = fresh.withColumn("value", F.when(F.col("entity") == "Generación", F.col("value") + 30).otherwise(F.col("value")))
    assert not verdict(missing, minute_agreement(wrong, minute_means(canonical(trend_store))), same_instant(wrong, canonical(trend_store)), ("Generación",), "Generación")

    out = export_all(trend_store, snaps, f"{tmp_path}/out")
    assert len(out) == 4 and spark.read.parquet(out[1]).count() == 1442 * 3 and spark.read.option("header", True).csv(out[2]).count() == 1442 * 3
    day = cov.cadence(snaps.filter("stream = 'gen.unit'"), "source_update_utc")
    spans = cov.label_intervals(cov.intervals(spark.createDataFrame([(1,), (2,), (9,)], "cell long")))
    write_manifests(spans, spans.limit(0), day, f"{tmp_path}/manifest")
    assert rows(spark.read.option("header", True).csv(f"{tmp_path}/manifest/held_intervals"), "start_local", "end_utc", "minutes") == [("1970-01-01 00:01", "1970-01-01 05:02Z", "2"), ("1970-01-01 00:09", "1970-01-01 05:09Z", "1")]
    assert rows(digest(snaps, ("stream",)).select("stream"))[0] == ("gen.pie",)


def test_fetch_log_batches_of_one_month_add_up(spark, tmp_path):
    row = lambda chunk, endpoint, status: (chunk, endpoint, status, True, 1.0, 10.0, 0.1, "t", None)
    other = NAME.replace("T1024", "T1029")
    batches = [[row(NAME, "gen", 200.0), row(NAME, "gen", 200.0)], [row(other, "gen", 500.0), row(NAME, "gen", 500.0), row("odd name", "gen", None)], []]
    for b in batches:
        merge_log(spark.createDataFrame(b, FETCH_LOG), f"{tmp_path}/log", FETCH_LOG, ("chunk", "endpoint"))
    assert rows(read_log(spark, f"{tmp_path}/log", FETCH_LOG), "chunk", "status") == [("odd name", None), (NAME, 200.0), (other, 500.0)]
    assert read_log(spark, f"{tmp_path}/none", FETCH_LOG).count() == 0


def test_a_merge_into_one_day_reads_that_day_only(spark, tmp_path):
    sample = lambda day, value: (datetime(2026, 1, day, 12, tzinfo=timezone.utc), None, "s", "e", "value", value, "MW", None, datetime(2026, 1, day, 13, tzinfo=timezone.utc), None)
    root = f"{tmp_path}/trend"
    assert len(merge_trend(spark.createDataFrame([sample(5, 1.0), sample(6, 1.0), (None, *sample(6, 1.0)[1:])], TREND), root)) == 2
    for f in (tmp_path / "trend" / "day=2026-01-05").glob("*.parquet"):
        f.write_bytes(b"unreadable")  # and so it shows if it is read
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    assert [str(p[0]) for p in merge_trend(spark.createDataFrame([sample(6, 2.0)], TREND), root)] == ["2026-01-06"]
    assert spark.read.schema(TREND).parquet(root + "/day=2026-01-06").count() == 2


def test_consolidation_writes_everything_and_the_ledger_last(spark, tmp_path):
    b = {"sin": clean()["sin"], "gen": {**clean()["gen"], "nuevo": [{"name": "q", "z": 1}]}}
    make_chunk(tmp_path / "in", NAME, b, probes={"dead": {"status": 200, "fetched_at_utc": "x"}, "gone": {"status": 404, "fetched_at_utc": "x"}})
    make_chunk(tmp_path / "in", "poll_20260929T103000Z_snap_ok2of2.tar.gz", {}, broken=True)
    make_chunk(tmp_path / "in", "poll_20260930T000000Z_snap_ok2of2.tar.gz", b)
    store, cutoff = f"{tmp_path}/store", F.lit("2026-09-30").cast("timestamp")
    done = consolidate(spark, f"{tmp_path}/in", store, cutoff=cutoff)
    assert (done.n_chunks, done.n_recent) == (2, 1) and rows(done.live, "endpoint") == [("dead",)]
    assert {(r.path, r.kind) for r in done.new_drift.collect()} == {("nuevo", "new_key"), ("poll_20260929T103000Z_snap_ok2of2.tar.gz", "chunk_unreadable")}
    n = spark.read.schema(SNAPSHOT).parquet(f"{store}/snapshots").count()
    assert rows(read_log(spark, f"{store}/ledger", LEDGER), "chunk", "snapshot_rows", "trend_rows", "drift_events") == [(NAME, str(n), str(1441 * 3), "1"), ("poll_20260929T103000Z_snap_ok2of2.tar.gz", "0", "0", "1")]
    log = rows(drift_log(spark, store))
    again = consolidate(spark, f"{tmp_path}/in", store, cutoff=cutoff)
    assert again.n_chunks == 0 and again.n_recent == 1
    forced = consolidate(spark, f"{tmp_path}/in", store, cutoff=cutoff, use_ledger=False)  # as after a crash before the ledger
    assert forced.snapshots == [] and forced.trend == [] and forced.new_drift.count() == 0 and rows(drift_log(spark, store)) == log
    assert consolidate(spark, f"{tmp_path}/in", store, cutoff=F.lit("2026-10-20").cast("timestamp"), lookback_days=14).n_chunks == 0
    assert consolidate(spark, f"{tmp_path}/in", store, cutoff=F.lit("2026-10-01").cast("timestamp"), lookback_days=14).n_chunks == 1
    assert rows(drift_log(spark, store), "path", "n_chunks")[0] == ("nuevo", 2) and rows(read_log(spark, f"{store}/probes", PROBES), "endpoint", "status") == [("dead", "200"), ("gone", "404")]
    assert read_log(spark, f"{store}/drift_events", DRIFT_EVENTS).count() == 3
    assert consolidate(spark, f"{tmp_path}/none-here", f"{tmp_path}/other").n_chunks == 0 if (tmp_path / "none-here").mkdir() is None else True


def test_bytes_that_are_no_utf8_are_invalid_json(spark):
    df = spark.createDataFrame([("gen", datetime(2026, 9, 29), NAME, b'{"update": "29-septiembre-2026 5:23:53", "pie": "\xff"}')], "endpoint string, fetched_at_utc timestamp, chunk string, body binary")
    assert [(r.path, r.kind) for r in drift_events(df).collect()] == [("$", "invalid_json")] and snapshot_rows(df).count() == 0


@pytest.mark.parametrize("broken", [[1, 2], "x", {"names": [], "series": [1, 2]}, {"names": [], "series": [{"value": 5, "time": {"y": "2026", "m": "8", "d": "29", "h": "5", "mi": "23"}}]}])
def test_trends_that_cannot_be_walked(spark, tmp_path, broken):
    make_chunk(tmp_path, NAME, {"sin": {**clean()["sin"], "trend": broken}})
    df = load(spark, tmp_path)
    assert [(r.path, r.kind) for r in drift_events(df).collect()] == [("trend", "parse_error")] and trend_rows(df).count() == 0


def test_release_days_ranges_and_months(spark):
    tags = spark.createDataFrame([("raw-2026-09-29",), ("raw-2026-09-30",), ("raw-2026-13-01",), ("v1",), (None,)], "tag string")
    day = release_day(F.col("tag"))
    assert rows(between_days(tags, day)) == [("raw-2026-09-29",), ("raw-2026-09-30",)]
    assert rows(between_days(tags, day, F.lit("2026-09-29").cast("date"), F.lit("2026-09-30").cast("date"))) == [("raw-2026-09-29",)]
    chunks = spark.createDataFrame([(datetime(2026, 9, 30, 23, 59, tzinfo=timezone.utc),), (datetime(2026, 10, 1, tzinfo=timezone.utc),)], "started_utc timestamp")
    assert of_month(chunks, "2026-09").count() == 1


def test_stream_takes_each_archive_once(spark, tmp_path):
    body = {"gen": clean()["gen"]}
    make_chunk(tmp_path / "in", NAME, body)
    run = lambda: stream_archives(spark, f"{tmp_path}/in", f"{tmp_path}/store", f"{tmp_path}/cp").awaitTermination()
    run()
    before = spark.read.parquet(f"{tmp_path}/store/snapshots").count()
    run()
    body["gen"]["update"] = "29-septiembre-2026 5:28:53"
    make_chunk(tmp_path / "in", "poll_20260929T102900Z_snap_ok1of1.tar.gz", body)
    run()
    assert before > 0 and spark.read.parquet(f"{tmp_path}/store/snapshots").count() == 2 * before
    assert read_log(spark, f"{tmp_path}/store/ledger", LEDGER).count() == 2 and read_log(spark, f"{tmp_path}/store/fetch_log", FETCH_LOG).count() == 2


def test_discovery_and_ledger(spark, tmp_path):
    for name in (NAME, "poll_20260929T102900Z_snap_ok4of6-xsin-xgen.tar.gz", "poll_20260930T000000Z_trend_ok1of1.tar.gz", "other.tar.gz"):
        make_chunk(tmp_path / "a" / "b", name, {})
    found = discover(spark, str(tmp_path))
    assert rows(found, "kind", "n_ok", "n", "failed") == [("snap", 4, 6, ["sin", "gen"]), ("snap", 6, 6, []), ("trend", 1, 1, [])]
    ledger = spark.createDataFrame([(NAME, None, None, None, None)], LEDGER)
    assert rows(pending(found, ledger, F.lit("2026-09-30").cast("timestamp")), "n_ok") == [(4,)]


def test_scalar_functions(spark):
    texts = ["29-septiembre-2026 5:17:08", "1-Setiembre-2026 5:17", "31-febrero-2026 1:00:00", "29-foo-2026 5:17:08", " 2-enero-2026 0:00:59 ", "2026-01-01", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.x for r in df.select("i", tp.spanish_ts(F.col("t")).alias("x")).orderBy("i").collect()]
    assert got == [datetime(2026, 9, 29, 5, 17, 8), datetime(2026, 9, 1, 5, 17), None, None, datetime(2026, 1, 2, 0, 0, 59), None, None]
    numbers = ["1,040.82", "75%", "1,345", "12,34", ".5", "5.", "1e5", "", "-3", "N/D", "-0.5 %", None]
    nd = spark.createDataFrame([(i, t) for i, t in enumerate(numbers)], "i int, t string").select("i", number_of(F.col("t")).alias("n"), text_beside(F.col("t")).alias("x")).orderBy("i").collect()
    assert [r.n for r in nd] == [1040.82, 75.0, 1345.0, None, 0.5, None, None, None, -3.0, None, -0.5, None]
    assert [r.x for r in nd] == ["1,040.82", "75%", "1,345", "12,34", None, "5.", "1e5", "", None, "N/D", "-0.5 %", None]
    at = spark.createDataFrame([(datetime(2026, 9, 29, 5, 0, tzinfo=timezone.utc), "20260929T050000Z", "x")], "u timestamp, c string, b string")
    r = at.select(tp.utc_to_local(F.col("u")).alias("l"), tp.local_to_utc(tp.utc_to_local(F.col("u"))).alias("u"), tp.parse_compact(F.col("c")).alias("c"), tp.parse_compact(F.col("b")).alias("b"), tp.scada_ts(F.lit("2026-01-02")).alias("s")).first()
    assert r.l == datetime(2026, 9, 29, 0, 0) and r.u == r.c == datetime(2026, 9, 29, 5, 0) and r.b is None and r.s is None


def test_streaming_views_equal_batch_ones(spark, tmp_path):
    at = lambda m: datetime(2026, 1, 5, tzinfo=timezone.utc).replace(hour=m // 60, minute=m % 60)
    data = [("e", at(m), float(v), at(m + k), at(m + k + 1)) for m in range(0, 200, 20) for k, v in enumerate((1, 1, 2))]
    df = spark.createDataFrame(data, "entity string, timestamp_utc timestamp, value double, first_seen_update_utc timestamp, last_seen_update_utc timestamp")
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    results = {}
    for name, view in (("versions", observed_versions(stream())), ("hours", hourly_stream(stream(), "timestamp_utc", "value"))):
        view.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", f"{tmp_path}/cp-{name}").trigger(availableNow=True).start().awaitTermination()
        results[name] = rows(spark.table(name))
    assert results["versions"] == rows(df.groupBy("entity", "timestamp_utc", "value").agg(F.min("first_seen_update_utc"), F.max("last_seen_update_utc")))
    assert results["hours"] == rows(df.groupBy(F.date_trunc("HOUR", "timestamp_utc")).agg(F.avg("value"), F.count("*")))

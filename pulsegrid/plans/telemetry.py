"""Queries of the archive's own operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timeparse as tp
from ..functions.values import PIE, number_of, pie_label, text_beside
from ..operators import coverage as cov
from ..operators import drift, monitor, verify
from ..operators.dedupe import first_per_key, upsert_rows
from ..operators.explode import literal_map, snapshot_rows
from ..operators.export import with_month, with_year
from ..operators.merge import merge_log, merge_snapshots, merge_trend, read_log
from ..operators.trend import trend_rows
from ..operators.views import canonical, hourly_means, minute_means, versions
from ..schema import BENIGN_DRIFT, FETCH_LOG, SNAPSHOT, SNAPSHOT_KEY, TREND, UNITS
from ..session import drop_path, prepare, work_path
from ..sources.archives import CHUNK, between_days, chunk_name, of_month, pending, release_day, with_info

QUERIES: dict = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def us(c: str) -> Column:
    return F.unix_micros(c).alias(c)


# --- versions and views -------------------------------------------------------------------------------------------
CANONICAL = """canon AS (SELECT * FROM trend_rows QUALIFY row_number() OVER (PARTITION BY entity, timestamp_utc ORDER BY last_seen_update_utc DESC NULLS LAST, first_seen_update_utc DESC NULLS LAST,
  value DESC NULLS LAST, timestamp_local DESC NULLS LAST, stream DESC NULLS LAST, field DESC NULLS LAST, unit DESC NULLS LAST, minute_label_local DESC NULLS LAST) = 1)"""


@query(f"WITH {CANONICAL} SELECT entity, epoch_us(timestamp_utc) AS timestamp_utc, value, epoch_us(first_seen_update_utc) AS first_seen_update_utc, epoch_us(last_seen_update_utc) AS last_seen_update_utc FROM canon")
def canonical_latest(spark, folder):
    return canonical(table(spark, folder, "trend_rows")).select("entity", us("timestamp_utc"), "value", us("first_seen_update_utc"), us("last_seen_update_utc"))


@query("""SELECT entity, epoch_us(timestamp_utc) AS timestamp_utc, value, max(unit) AS unit, epoch_us(min(first_seen_update_utc)) AS first_seen_update_utc, epoch_us(max(last_seen_update_utc)) AS last_seen_update_utc
FROM trend_rows GROUP BY entity, timestamp_utc, value""")
def trend_versions(spark, folder):
    return versions(table(spark, folder, "trend_rows")).select("entity", us("timestamp_utc"), "value", "unit", us("first_seen_update_utc"), us("last_seen_update_utc"))


@query(f"""WITH {CANONICAL} SELECT entity, minute_label_local AS timestamp_local, epoch_us(minute_label_local) + 18000000000 AS timestamp_utc, avg(value) AS value, count(*) AS n_samples
FROM canon WHERE entity IS NOT NULL AND minute_label_local IS NOT NULL GROUP BY entity, minute_label_local""")
def minute_mean(spark, folder):
    return minute_means(canonical(table(spark, folder, "trend_rows"))).select("entity", "timestamp_local", us("timestamp_utc"), "value", "n_samples")


@query(f"""WITH {CANONICAL}, held AS (SELECT entity, epoch_us(timestamp_utc) // 3600000000 AS h, avg(value) AS value FROM canon WHERE entity IS NOT NULL GROUP BY ALL),
grid AS (SELECT entity, unnest(range(min(h), max(h) + 1)) AS h FROM held GROUP BY entity)
SELECT g.entity, make_timestamp(g.h * 3600000000) AS hour, held.value FROM grid g LEFT JOIN held USING (entity, h)""")
def hourly_mean_grid(spark, folder):
    return hourly_means(canonical(table(spark, folder, "trend_rows")))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS hour, avg(value) AS value, count(*) AS n FROM events GROUP BY ALL")
def tumbling_hours(spark, folder):
    return table(spark, folder, "events").groupBy(F.window("ts", "1 hour").alias("w")).agg(F.avg("value").alias("value"), F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "value", "n")


_FIRST = "FROM snapshot_rows QUALIFY row_number() OVER (PARTITION BY stream, entity, field, timestamp_utc ORDER BY fetched_at_utc NULLS LAST, chunk NULLS LAST, row_id) = 1"


@query(f"SELECT row_id, stream, entity, field, epoch_us(timestamp_utc) AS timestamp_utc, value, value_text, unit, epoch_us(fetched_at_utc) AS fetched_at_utc, chunk {_FIRST}")
def dedupe_first(spark, folder):
    kept = first_per_key(table(spark, folder, "snapshot_rows"), SNAPSHOT_KEY, ("fetched_at_utc", "chunk", "row_id"))
    return kept.select("row_id", "stream", "entity", "field", us("timestamp_utc"), "value", "value_text", "unit", us("fetched_at_utc"), "chunk")


# --- merges into a store -------------------------------------------------------------------------------------------
@query("""WITH ms AS (SELECT stream, entity, field, date_trunc('millisecond', timestamp_utc) AS t, value, fetched_at_utc, chunk FROM snapshot_rows)
SELECT stream, entity, field, epoch_us(t) AS timestamp_utc, chunk FROM ms QUALIFY row_number() OVER (PARTITION BY stream, entity, field, t ORDER BY fetched_at_utc NULLS LAST, chunk NULLS LAST) = 1""")
def merge_snapshots_store(spark, folder):
    """Two overlapping halves merged one after the other, read back from the store."""
    rows = table(spark, folder, "snapshot_rows")
    root = work_path(spark, "store")
    for part in (rows.filter("fetched_at_utc < timestamp '2026-01-06 12:00:00' or fetched_at_utc is null"), rows.filter("fetched_at_utc >= timestamp '2026-01-06 00:00:00' or fetched_at_utc is null")):
        merge_snapshots(part, root)
    return spark.read.schema(SNAPSHOT).parquet(root).select("stream", "entity", "field", us("timestamp_utc"), "chunk")


@query("""SELECT entity, epoch_us(timestamp_utc) AS timestamp_utc, value, epoch_us(min(first_seen_update_utc)) AS first_seen_update_utc, epoch_us(max(last_seen_update_utc)) AS last_seen_update_utc
FROM trend_rows GROUP BY entity, timestamp_utc, value""")
def merge_trend_store(spark, folder):
    rows = table(spark, folder, "trend_rows")
    root = work_path(spark, "store")
    for part in (rows.filter("hour(first_seen_update_utc) < 14 or first_seen_update_utc is null"), rows.filter("hour(first_seen_update_utc) >= 10 or first_seen_update_utc is null")):
        merge_trend(part, root)
    return spark.read.schema(TREND).parquet(root).select("entity", us("timestamp_utc"), "value", us("first_seen_update_utc"), us("last_seen_update_utc"))


@query("SELECT 1 AS pass, true AS changed UNION ALL SELECT 2, false")
def merge_again_is_no_change(spark, folder):
    rows = table(spark, folder, "trend_rows")
    root = work_path(spark, "store")
    passes = [(i, bool(merge_trend(rows, root))) for i in (1, 2)]
    drop_path(spark, root)
    return spark.createDataFrame(passes, "pass int, changed boolean")


@query("""SELECT chunk, ingested_at_utc, snapshot_rows, trend_rows, drift_events FROM (SELECT *, 0 AS side FROM ingested_chunks WHERE snapshot_rows <> 'nan' UNION ALL SELECT *, 1 FROM ingested_chunks)
QUALIFY row_number() OVER (PARTITION BY chunk ORDER BY side, ingested_at_utc, snapshot_rows, trend_rows, drift_events) = 1""")
def upsert_merge(spark, folder):
    ledger = table(spark, folder, "ingested_chunks")
    return upsert_rows(ledger.filter("snapshot_rows <> 'nan'"), ledger, ("chunk",), ("ingested_at_utc", "snapshot_rows", "trend_rows", "drift_events"))


@query("""SELECT chunk, endpoint, substr(chunk, 6, 6) AS month, ok, status, attempts FROM fetch_log
QUALIFY row_number() OVER (PARTITION BY chunk, endpoint ORDER BY fetched_at_utc NULLS LAST, status NULLS LAST, ok, attempts NULLS LAST, elapsed_s NULLS LAST, bytes NULLS LAST) = 1""")
def fetch_log_monthly(spark, folder):
    once = first_per_key(table(spark, folder, "fetch_log"), ("chunk", "endpoint"), ("fetched_at_utc", "status", "ok", "attempts", "elapsed_s", "bytes"))
    return once.select("chunk", "endpoint", tp.month_of_chunk(F.col("chunk")).alias("month"), "ok", "status", "attempts")


@query("""SELECT chunk, endpoint, status, ok, attempts, bytes FROM fetch_log
QUALIFY row_number() OVER (PARTITION BY chunk, endpoint ORDER BY status NULLS LAST, ok NULLS LAST, attempts NULLS LAST, bytes NULLS LAST, elapsed_s NULLS LAST, fetched_at_utc NULLS LAST, error NULLS LAST) = 1""")
def fetch_log_batches(spark, folder):
    """Two batches that share a month, written one after the other and read back: neither replaces the other."""
    log = table(spark, folder, "fetch_log")
    root = work_path(spark, "store")
    early = F.col("endpoint").isin("sin", "gen", "vert")
    for part in (log.filter(early), log.filter(~early), log.filter(early)):
        merge_log(part, root, FETCH_LOG, ("chunk", "endpoint"))
    return read_log(spark, root, FETCH_LOG).select("chunk", "endpoint", "status", "ok", "attempts", "bytes")


# --- coverage ------------------------------------------------------------------------------------------------------
COVER = """minutes AS (SELECT entity, epoch_us(date_trunc('minute', minute_label_local)) // 60000000 AS cell, timestamp_utc FROM trend_rows WHERE value IS NOT NULL AND entity IS NOT NULL AND minute_label_local IS NOT NULL),
held AS (SELECT cell, count(DISTINCT entity) AS n_series FROM minutes GROUP BY cell),
marked AS (SELECT cell, n_series = (SELECT count(DISTINCT entity) FROM trend_rows WHERE value IS NOT NULL) AS is_held FROM held),
win AS (SELECT g.cell, coalesce(m.is_held, false) AS is_held FROM (SELECT unnest(range((SELECT min(cell) FROM marked WHERE is_held), (SELECT max(cell) FROM marked) + 1)) AS cell) g LEFT JOIN marked m USING (cell))"""
_RUNS = """SELECT min(cell) AS start_cell, max(cell) AS end_cell, count(*) AS n_cells FROM (SELECT cell, cell - row_number() OVER (ORDER BY cell) AS g FROM win WHERE {cond}) GROUP BY g"""


def minute() -> Column:
    """Minutes are local ones, told by their label; rows without label are in none."""
    return cov.label_minute("minute_label_local")


def _samples(spark, folder) -> DataFrame:
    return table(spark, folder, "trend_rows").filter("value is not null")


def _window(spark, folder) -> DataFrame:
    return cov.grid(_samples(spark, folder), "entity", minute())


@query(f"WITH {COVER} SELECT cell, n_series FROM held")
def coverage_counts(spark, folder):
    return cov.held_cells(_samples(spark, folder), "entity", minute())


@query(f"WITH {COVER} SELECT count(*) AS n_expected, count(*) FILTER (is_held) AS n_held, avg(is_held::INT) AS completeness FROM win")
def coverage_summary(spark, folder):
    return cov.coverage_summary(_window(spark, folder))


@query(f"WITH {COVER} " + _RUNS.format(cond="NOT is_held"))
def missing_intervals(spark, folder):
    return cov.intervals(_window(spark, folder).filter("not is_held"))


@query(f"WITH {COVER} " + _RUNS.format(cond="is_held"))
def held_intervals(spark, folder):
    return cov.intervals(_window(spark, folder).filter("is_held"))


@query("""WITH labels AS (SELECT entity, date_trunc('minute', minute_label_local) AS t FROM trend_rows WHERE value IS NOT NULL AND minute_label_local IS NOT NULL),
full_ones AS (SELECT t FROM labels GROUP BY t HAVING count(DISTINCT entity) = (SELECT count(DISTINCT entity) FROM trend_rows WHERE value IS NOT NULL)),
gaps AS (SELECT t, t - INTERVAL 1 MINUTE * row_number() OVER (ORDER BY t) AS g FROM (SELECT unnest(generate_series((SELECT min(t) FROM full_ones), (SELECT max(t) FROM labels), INTERVAL 1 MINUTE)) AS t) WHERE t NOT IN (FROM full_ones))
SELECT min(t) AS start_local, max(t) AS end_local, epoch_us(min(t) + INTERVAL 5 HOUR) AS start_utc, epoch_us(max(t) + INTERVAL 5 HOUR) AS end_utc, count(*) AS minutes FROM gaps GROUP BY g""")
def interval_manifest(spark, folder):
    return cov.label_intervals(cov.intervals(_window(spark, folder).filter("not is_held"))).select("start_local", "end_local", us("start_utc"), us("end_utc"), "minutes")


@query(f"WITH {COVER} SELECT start_cell, end_cell, n_cells, greatest(n_all - 50, 0) AS n_more FROM (SELECT *, count(*) OVER () AS n_all FROM (" + _RUNS.format(cond="NOT is_held") + ")) ORDER BY start_cell LIMIT 50")
def top_n_intervals(spark, folder):
    return cov.top_intervals(cov.intervals(_window(spark, folder).filter("not is_held")), 50)


@query(f"WITH {COVER} SELECT start_cell, end_cell FROM (" + _RUNS.format(cond="NOT is_held") + ") WHERE n_cells < 3")
def new_gaps(spark, folder):
    """Gaps that an earlier list, here of the longer ones, doesn't have."""
    gaps = cov.intervals(_window(spark, folder).filter("not is_held"))
    return cov.new_intervals(gaps, gaps.filter("n_cells >= 3"))


@query("""WITH m AS (SELECT DISTINCT entity, epoch_us(minute_label_local) // 60000000 AS cell FROM trend_rows WHERE value IS NOT NULL AND minute_label_local IS NOT NULL)
SELECT entity, min(cell) AS start_cell, max(cell) AS end_cell, count(*) AS n_cells FROM (SELECT entity, cell, cell - row_number() OVER (PARTITION BY entity ORDER BY cell) AS g FROM m) GROUP BY entity, g""")
def series_intervals(spark, folder):
    """Session-like intervals: runs of minutes per series."""
    return cov.intervals(_samples(spark, folder).select("entity", minute().alias("cell")).filter("cell is not null"), ("entity",))


_SINCE, _UNTIL = 29_459_220, 29_460_720  # 2026-01-04 19:00 and 25 hours on, in minutes


@query(f"""WITH {COVER} SELECT count(*) AS n_expected, count(*) FILTER (is_held) AS n_held, avg(is_held::INT) AS completeness
FROM (SELECT g.cell, coalesce(m.is_held, false) AS is_held FROM (SELECT unnest(range({_SINCE}, {_UNTIL} + 1)) AS cell) g LEFT JOIN marked m USING (cell))""")
def coverage_since_until(spark, folder):
    """Completeness of a given window instead of the data's own."""
    return cov.coverage_summary(cov.grid(_samples(spark, folder), "entity", minute(), _SINCE, _UNTIL))


@query(f"WITH {COVER} SELECT entity AS series, count(DISTINCT cell) AS n_held FROM minutes WHERE cell IN (SELECT cell FROM win) GROUP BY entity")
def held_per_series(spark, folder):
    return cov.held_per_series(_samples(spark, folder), "entity", minute(), _window(spark, folder))


PHASES = f"WITH {COVER}, per AS (SELECT w.cell, count(DISTINCT m.timestamp_utc) AS n_phases FROM win w JOIN minutes m USING (cell) WHERE w.is_held GROUP BY w.cell)"


@query(PHASES + " SELECT n_phases, count(*) AS n_cells FROM per GROUP BY n_phases")
def phase_histogram(spark, folder):
    return cov.phase_histogram(cov.phases(_samples(spark, folder), "timestamp_utc", minute(), _window(spark, folder)))


@query(PHASES + " SELECT avg(n_phases) AS phase_mean FROM per")
def phase_mean(spark, folder):
    return cov.phases(_samples(spark, folder), "timestamp_utc", minute(), _window(spark, folder)).agg(F.avg("n_phases").alias("phase_mean"))


@query("""WITH v AS (SELECT DISTINCT entity, timestamp_utc, value FROM trend_rows), n AS (SELECT entity, timestamp_utc, count(*) AS n FROM v GROUP BY ALL)
SELECT entity AS series, count(*) AS n_samples, count(*) FILTER (n > 1) AS n_revised FROM n GROUP BY entity""")
def revision_stats(spark, folder):
    return cov.revision_stats(versions(table(spark, folder, "trend_rows")), "entity", "timestamp_utc")


@query("""WITH u AS (SELECT DISTINCT source_update_utc AS t FROM snapshot_rows WHERE stream = 'gen.unit' AND source_update_utc IS NOT NULL),
g AS (SELECT t, (epoch_us(t) // 86400000000)::INT AS d, (epoch_us(t) - lag(epoch_us(t)) OVER (PARTITION BY epoch_us(t) // 86400000000 ORDER BY t)) / 6e7 AS gap FROM u)
SELECT strftime(DATE '1970-01-01' + d, '%Y-%m-%d') AS day_utc, count(*) AS observations, median(gap) AS median_spacing_min, quantile_cont(gap, 0.95) AS p95_spacing_min, max(gap) AS max_spacing_min, 100.0::DOUBLE * count(*) / 288 AS pct_of_expected FROM g GROUP BY d""")
def cadence_by_day(spark, folder):
    return cov.cadence(table(spark, folder, "snapshot_rows").filter("stream = 'gen.unit'"), "source_update_utc").withColumn("day_utc", F.col("day_utc").cast("string"))


@query("""WITH m AS (SELECT DISTINCT entity, date_trunc('minute', minute_label_local) AS t FROM trend_rows WHERE minute_label_local IS NOT NULL),
g AS (SELECT entity, epoch_us(t) - lag(epoch_us(t)) OVER (PARTITION BY entity ORDER BY t) AS gap FROM m)
SELECT entity, count(*) FILTER (gap <> 60000000) AS n_steps FROM g GROUP BY entity""")
def step_anomalies(spark, folder):
    rows = table(spark, folder, "trend_rows").select("entity", tp.floor_minute(F.col("minute_label_local")).cast("timestamp_ntz").alias("t"))
    return cov.step_anomalies(rows, ("entity",), "t", 60)


@query("""WITH u AS (SELECT DISTINCT source_update_utc AS t FROM snapshot_rows WHERE stream = 'gen.unit' AND source_update_utc IS NOT NULL)
SELECT strftime(make_timestamp(epoch_us(t)), '%Y-%m-%d') AS day_utc, count(*) AS observations FROM u GROUP BY 1 ORDER BY 1 DESC LIMIT 31""")
def cadence_last_days(spark, folder):
    """The latest 31 days of the cadence table."""
    return cov.last_days(cadence_by_day(spark, folder)).select("day_utc", "observations")


# --- verification --------------------------------------------------------------------------------------------------
FRESH = CANONICAL + """, fresh AS (SELECT entity, timestamp_utc, minute_label_local, value FROM trend_rows WHERE value IS NOT NULL AND minute_label_local IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY entity, timestamp_utc ORDER BY first_seen_update_utc NULLS LAST, value, minute_label_local) = 1),
mins AS (SELECT entity, minute_label_local, avg(value) AS b FROM canon WHERE minute_label_local IS NOT NULL GROUP BY ALL)"""


def _fresh(spark, folder) -> DataFrame:
    rows = table(spark, folder, "trend_rows").filter("value is not null and minute_label_local is not null").select("entity", "timestamp_utc", "minute_label_local", "value", "first_seen_update_utc")
    return first_per_key(rows, ("entity", "timestamp_utc"), ("first_seen_update_utc", "value", "minute_label_local"))


@query(f"""WITH {FRESH} SELECT f.entity, count(*) AS n, count(*) FILTER (abs(f.value - c.value) = 0) AS n_exact, max(abs(f.value - c.value)) AS max_diff, avg(coalesce(abs(f.value - c.value) = 0, false)::INT) AS exact_share
FROM fresh f JOIN canon c ON f.entity = c.entity AND f.timestamp_utc = c.timestamp_utc GROUP BY f.entity""")
def same_instant_compare(spark, folder):
    """First published values against the canonical ones."""
    rows = table(spark, folder, "trend_rows")
    return verify.same_instant(verify.window_of(_fresh(spark, folder), rows), canonical(rows))


@query(f"""WITH {FRESH} SELECT f.entity, count(*) AS n, median(abs(f.value - m.b)) AS median_diff, quantile_cont(abs(f.value - m.b), 0.99) AS p99_diff, round(corr(f.value, m.b), 6) AS corr
FROM fresh f JOIN mins m ON f.entity = m.entity AND f.minute_label_local = m.minute_label_local GROUP BY f.entity""")
def minute_agreement(spark, folder):
    rows = table(spark, folder, "trend_rows")
    return verify.minute_agreement(_fresh(spark, folder), minute_means(canonical(rows))).withColumn("corr", F.round("corr", 6))


@query("""WITH h AS (SELECT minute_label_local, count(DISTINCT entity) AS n FROM trend_rows GROUP BY ALL)
SELECT DISTINCT t.minute_label_local FROM trend_rows t JOIN h USING (minute_label_local) WHERE h.n < 3""")
def verify_missing_minutes(spark, folder):
    rows = table(spark, folder, "trend_rows")
    return verify.missing_minutes(rows.filter("minute_label_local is not null"), rows, 3)


# --- ledgers, logs and rules ----------------------------------------------------------------------------------------
def _info(name: str) -> str:
    part = lambda i: f"regexp_extract(chunk, '{CHUNK}', {i})"
    return f"""info AS (SELECT chunk, strptime({part(1)}, '%Y%m%dT%H%M%SZ') AS started, {part(2)} AS kind, {part(3)}::INT AS n_ok, {part(4)}::INT AS n, CASE WHEN {part(5)} = '' THEN [] ELSE string_split(substr({part(5)}, 3), '-x') END AS failed
  FROM (SELECT DISTINCT chunk FROM {name}) WHERE regexp_matches(chunk, '{CHUNK}'))"""


def _chunks(spark, folder, name: str) -> DataFrame:
    return with_info(table(spark, folder, name).select("chunk").distinct())


@query("WITH " + _info("fetch_log") + " SELECT chunk, epoch_us(started) AS started_utc, kind, n_ok, n, array_to_string(failed, ' ') AS failed FROM info")
def chunk_name_parse(spark, folder):
    return _chunks(spark, folder, "fetch_log").select("chunk", us("started_utc"), "kind", "n_ok", "n", F.array_join("failed", " ").alias("failed"))


@query("WITH " + _info("fetch_log") + " SELECT chunk, true AS same FROM info")
def chunk_name_round_trip(spark, folder):
    c = _chunks(spark, folder, "fetch_log")
    again = chunk_name(F.col("started_utc"), F.col("kind"), F.col("n_ok"), F.col("n"), F.col("failed"), prefix="x")
    return c.select("chunk", (F.regexp_replace("chunk", "^[a-z]+_", "") == F.regexp_replace(again, "^x_", "")).alias("same"))


@query("WITH " + _info("fetch_log") + " SELECT chunk FROM info WHERE started < TIMESTAMP '2026-01-08' AND chunk NOT IN (SELECT chunk FROM ingested_chunks WHERE chunk IS NOT NULL)")
def ledger_anti(spark, folder):
    return pending(_chunks(spark, folder, "fetch_log"), table(spark, folder, "ingested_chunks"), F.lit("2026-01-08").cast("timestamp")).select("chunk")


@query("WITH " + _info("fetch_log") + """ SELECT chunk FROM info WHERE started < TIMESTAMP '2026-01-08' AND started >= TIMESTAMP '2026-01-06' AND chunk NOT IN (SELECT chunk FROM ingested_chunks WHERE chunk IS NOT NULL AND snapshot_rows = 'nan')""")
def pull_lookback(spark, folder):
    """Chunks of the last two days that a ledger, here of few chunks, doesn't have."""
    ledger = table(spark, folder, "ingested_chunks").filter("snapshot_rows = 'nan'")
    return pending(_chunks(spark, folder, "fetch_log"), ledger, F.lit("2026-01-08").cast("timestamp"), 2).select("chunk")


@query("WITH " + _info("fetch_log") + " SELECT strftime(started, '%Y-%m') AS month, count(*) AS n FROM info WHERE strftime(started, '%Y-%m') = '2026-01' GROUP BY 1")
def month_pull(spark, folder):
    chunks = of_month(_chunks(spark, folder, "fetch_log"), "2026-01")
    return chunks.groupBy(F.date_format("started_utc", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("SELECT issue_day, count(*) AS n FROM documents WHERE try_strptime(issue_day, '%Y-%m-%d') >= DATE '1885-01-01' AND try_strptime(issue_day, '%Y-%m-%d') < DATE '1895-01-01' GROUP BY 1")
def release_range(spark, folder):
    """Tags of days within a range, the end left out."""
    tags = table(spark, folder, "documents").select("issue_day", F.concat(F.lit("raw-"), "issue_day").alias("tag"))
    day = release_day(F.col("tag"))
    return between_days(tags, day, F.lit("1885-01-01").cast("date"), F.lit("1895-01-01").cast("date")).groupBy("issue_day").agg(F.count("*").alias("n"))


@query("WITH " + _info("fetch_log") + " SELECT epoch_us(max(started)) AS last_started_utc FROM info WHERE kind = 'snap'")
def latest_chunk(spark, folder):
    return monitor.latest_chunk(_chunks(spark, folder, "fetch_log")).select(us("last_started_utc"))


_KIND = "regexp_extract(chunk, '^[a-z]+_[0-9TZ]+_([a-z]+)_', 1)"


@query(f"""WITH f AS (SELECT chunk || '/' || endpoint AS chunk, endpoint, status, ok, replace(error, 'HTTP 5xx', 'Cloudflare') AS error, {_KIND} AS kind FROM fetch_log), g AS (SELECT chunk, kind, coalesce(bool_or(status IN (401, 403) OR (status = 503 AND lower(error) LIKE '%cloudflare%')), false) AS refused,
  bool_or(coalesce(ok, false)) AS any_ok, coalesce(bool_or(coalesce(ok, false) AND endpoint = 'sin'), false) AS sin_ok FROM f GROUP BY ALL)
SELECT chunk, 'blocked' AS alert FROM g WHERE kind = 'snap' AND refused UNION ALL SELECT chunk, 'fetch-failing' FROM g WHERE kind = 'snap' AND NOT any_ok UNION ALL SELECT chunk, 'trend-capture-failing' FROM g WHERE kind = 'trend' AND NOT sin_ok""")
def capture_alerts(spark, folder):
    """Each fetch as a poll of its own; errors of one kind stand for a challenge page."""
    log = table(spark, folder, "fetch_log").withColumn("kind", F.regexp_extract("chunk", "^[a-z]+_[0-9TZ]+_([a-z]+)_", 1))
    return monitor.capture_alerts(log.withColumn("chunk", F.concat_ws("/", "chunk", "endpoint")).withColumn("error", F.replace("error", F.lit("HTTP 5xx"), F.lit("Cloudflare"))))


@query("""WITH e AS (SELECT chunk, endpoint, ok, try_cast(fetched_at_utc AS TIMESTAMPTZ) AS t FROM fetch_log WHERE endpoint IS NOT NULL),
firing AS (SELECT DISTINCT chunk || '/' || endpoint AS alert FROM e WHERE NOT ok), tally AS (SELECT chunk || '/' || endpoint AS alert, max(t) AS at FROM e WHERE t IS NOT NULL GROUP BY 1)
SELECT f.alert, CASE WHEN o.alert IS NULL THEN 'open' WHEN o.at < TIMESTAMPTZ '2026-01-06 00:00:00+00' - INTERVAL 12 HOUR THEN 'repeat' ELSE 'none' END AS action FROM firing f LEFT JOIN tally o ON o.alert = f.alert
UNION ALL SELECT o.alert, 'close' FROM tally o WHERE o.alert NOT IN (SELECT alert FROM firing) AND o.alert IN (SELECT chunk || '/' || endpoint FROM e WHERE ok)""")
def alert_actions(spark, folder):
    """Every failed fetch fires, every fetch with a time is open, every success resolves."""
    log = table(spark, folder, "fetch_log").filter("endpoint is not null").withColumn("alert", F.concat_ws("/", "chunk", "endpoint")).withColumn("updated_utc", tp.iso_ts(F.col("fetched_at_utc")))
    return monitor.alert_actions(log.filter("not ok"), log.filter("updated_utc is not null"), log.filter("ok"), F.lit("2026-01-06 00:00:00").cast("timestamp"))


@query("""SELECT f.chunk, coalesce(try_cast(l.n AS BIGINT), 0) AS snapshot_rows FROM (SELECT DISTINCT chunk FROM fetch_log) f
LEFT JOIN (SELECT chunk, max(try_cast(snapshot_rows AS BIGINT)) AS n FROM ingested_chunks GROUP BY chunk) l USING (chunk)""")
def lookup_default(spark, folder):
    ledger = table(spark, folder, "ingested_chunks").groupBy("chunk").agg(F.max(F.col("snapshot_rows").try_cast("bigint")).alias("n"))
    return table(spark, folder, "fetch_log").select("chunk").distinct().join(ledger, "chunk", "left").select("chunk", F.coalesce("n", F.lit(0)).alias("snapshot_rows"))


NOW = "TIMESTAMP '2026-01-05 20:00:00'"


def _now() -> Column:
    return F.lit("2026-01-05 20:00:00").cast("timestamp")


_RATES = f"""rates AS (SELECT e AS endpoint, count(*) AS n, avg(list_contains(failed, e)::INT) AS rate FROM (SELECT failed, unnest(['sin', 'gen', 'vert', 'int', 'diagram', 'flow']) AS e FROM info
  WHERE kind = 'snap' AND started >= {NOW} - INTERVAL 12 HOUR) GROUP BY e)"""


@query("WITH " + _info("fetch_log") + f", {_RATES} SELECT endpoint, n, rate FROM rates")
def failure_rates(spark, folder):
    return monitor.failure_rates(_chunks(spark, folder, "fetch_log"), _now())


@query("WITH " + _info("fetch_log") + f""", {_RATES}, late AS (SELECT * FROM info WHERE started < {NOW} - INTERVAL 7 HOUR),
facts AS (SELECT max(started) FILTER (n_ok > 0) AS a, max(started) FILTER (n_ok > 0 AND NOT list_contains(failed, 'sin')) AS t, count(*) FILTER (kind = 'snap' AND started >= {NOW} - INTERVAL 12 HOUR) AS r FROM late)
SELECT 'snapshot-stale' AS alert FROM facts WHERE a IS NULL OR {NOW} - a > INTERVAL 90 MINUTE UNION ALL SELECT 'sin-stale' FROM facts WHERE t IS NULL OR {NOW} - t > INTERVAL 6 HOUR
UNION ALL SELECT 'snapshot-cadence' FROM facts WHERE r < 72
UNION ALL SELECT 'endpoint-failing-' || endpoint FROM (SELECT e AS endpoint, avg(list_contains(failed, e)::INT) AS rate FROM (SELECT failed, unnest(['sin', 'gen', 'vert', 'int', 'diagram', 'flow']) AS e FROM late
  WHERE kind = 'snap' AND started >= {NOW} - INTERVAL 12 HOUR) GROUP BY e) WHERE rate > 0.2""")
def staleness(spark, folder):
    """The rules as they'd fire had polling stopped seven hours ago."""
    late = _chunks(spark, folder, "fetch_log").filter(F.col("started_utc") < _now() - F.expr("INTERVAL 7 HOURS"))
    return monitor.alerts(late, _now()).select("alert")


@query("SELECT chunk, endpoint, status::INT AS status FROM fetch_log WHERE status = 200")
def live_probes(spark, folder):
    probes = table(spark, folder, "fetch_log").select("chunk", "endpoint", F.col("status").cast("int").cast("string").alias("status"))
    return monitor.live_probes(probes).withColumn("status", F.col("status").cast("int"))


@query("""SELECT endpoint, path, kind, regexp_replace(example, '\\d+', '#', 'g') AS masked, count(*) AS n FROM drift_log GROUP BY ALL""")
def digit_mask(spark, folder):
    return table(spark, folder, "drift_log").groupBy("endpoint", "path", "kind", tp.mask_digits(F.col("example")).alias("masked")).agg(F.count("*").alias("n"))


@query("""SELECT endpoint, path, kind, regexp_replace(example, '\\d+', '#', 'g') AS pattern, arg_min(severity, (first_seen_chunk, example)) AS severity, arg_min(example, (first_seen_chunk, example)) AS example,
  min(first_seen_chunk) AS first_seen_chunk, max(first_seen_chunk) AS last_seen_chunk, count(DISTINCT first_seen_chunk) AS n_chunks FROM drift_log GROUP BY ALL""")
def drift_rollup(spark, folder):
    events = table(spark, folder, "drift_log").select("endpoint", "path", "kind", F.col("example").alias("detail"), "severity", F.col("first_seen_chunk").alias("chunk"))
    return drift.drift_rollup(events)


@query("""WITH b AS (SELECT *, CASE WHEN severity = 'nan' THEN 1 ELSE 0 END AS side FROM drift_log)
SELECT endpoint, path, kind, pattern, arg_min(first_seen_chunk, (side, first_seen_chunk)) AS first_seen_chunk, max(last_seen_chunk) AS last_seen_chunk, sum(coalesce(try_cast(n_chunks AS BIGINT), 0))::BIGINT AS n_chunks
FROM b GROUP BY endpoint, path, kind, pattern""")
def drift_upsert(spark, folder):
    log = table(spark, folder, "drift_log")
    return drift.upsert_drift_log(log.filter("severity <> 'nan'"), log.filter("severity = 'nan'")).drop("severity", "example")


@query("""SELECT DISTINCT endpoint, path, kind, pattern FROM drift_log d WHERE kind NOT IN ('irregular_step', 'empty_values')
AND NOT EXISTS (SELECT 1 FROM drift_log o WHERE o.severity = 'ERROR' AND o.endpoint = d.endpoint AND o.path = d.path AND o.kind = d.kind AND o.pattern = d.pattern)""")
def drift_new_kinds(spark, folder):
    """What a log that holds errors only doesn't know yet."""
    log = table(spark, folder, "drift_log")
    return drift.new_kinds(log.filter("severity = 'ERROR'"), log, BENIGN_DRIFT).select("endpoint", "path", "kind", "pattern").distinct()


@query()
def bodies_to_rows(spark, folder):
    """Bodies parsed to long rows."""
    return snapshot_rows(table(spark, folder, "raw_bodies")).select("stream", "entity", "field", us("timestamp_utc"), "value", "value_text", "unit", "chunk")


@query()
def bodies_drift(spark, folder):
    return drift.drift_rollup(drift.drift_events(table(spark, folder, "raw_bodies")))


# --- scalar functions ------------------------------------------------------------------------------------------------
_NUM = r"^[+-]?(\d{1,3}(,\d{3})+|\d+)?(\.\d+)?$"


@query(f"""WITH t AS (SELECT DISTINCT value_text AS raw, trim(value_text, chr(32) || chr(9) || chr(10) || chr(13)) AS s FROM register_rows WHERE value_text IS NOT NULL),
k AS (SELECT *, regexp_matches(s, '{_NUM}') AND regexp_matches(s, '\\d') AS num, trim(regexp_replace(s, '%$', '')) AS p FROM t)
SELECT raw, CASE WHEN num THEN replace(s, ',', '')::DOUBLE WHEN s LIKE '%\\%' ESCAPE '\\' AND regexp_matches(p, '{_NUM}') AND regexp_matches(p, '\\d') THEN replace(p, ',', '')::DOUBLE END AS number,
  CASE WHEN num AND s NOT LIKE '%,%' THEN NULL ELSE raw END AS kept FROM k""")
def numeric_text_parse(spark, folder):
    raw = table(spark, folder, "register_rows").filter("value_text is not null").select(F.col("value_text").alias("raw")).distinct()
    return raw.select("raw", number_of(F.col("raw")).alias("number"), text_beside(F.col("raw")).alias("kept"))


@query("""SELECT chunk, endpoint, try_strptime(regexp_extract(body, '"update": ?"(\\d+)-', 1) || ' ' || CASE regexp_extract(body, '"update": ?"\\d+-([a-z]+)-', 1) WHEN 'enero' THEN '1' WHEN 'febrero' THEN '2' WHEN 'marzo' THEN '3'
 WHEN 'abril' THEN '4' WHEN 'mayo' THEN '5' WHEN 'junio' THEN '6' WHEN 'julio' THEN '7' WHEN 'agosto' THEN '8' WHEN 'septiembre' THEN '9' WHEN 'octubre' THEN '10' WHEN 'noviembre' THEN '11' WHEN 'diciembre' THEN '12' END
 || ' ' || regexp_extract(body, '"update": ?"\\d+-[a-z]+-(\\d{4} [0-9:]+)"', 1), '%d %m %Y %H:%M:%S') AS update_local FROM raw_bodies WHERE body IS NOT NULL""")
def spanish_ts_parse(spark, folder):
    text = F.regexp_extract("body", r'"update": ?"([^"]*)"', 1)
    return table(spark, folder, "raw_bodies").filter("body is not null").select("chunk", "endpoint", tp.spanish_ts(text).alias("update_local"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('millisecond', ts) END AS at FROM events")
def scada_ts_parse(spark, folder):
    """A round trip through the format; every seventh text is malformed."""
    text = F.when(F.col("event_id") % 7 == 0, F.date_format("ts", "yyyy/MM/dd HH:mm")).otherwise(F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")))
    return table(spark, folder, "events").select("event_id", tp.scada_ts(text).alias("at"))


@query("""SELECT o_orderkey, o_orderpriority || ' x' AS entity, o_orderkey % 1000 / 10.0::DOUBLE AS value, o_orderkey % 100 / 4.0::DOUBLE AS share FROM orders""")
def pie_label_parse(spark, folder):
    label = F.format_string("%s x %.1f (%.2f%%)", "o_orderpriority", F.col("o_orderkey") % 1000 / 10.0, F.col("o_orderkey") % 100 / 4.0)
    _, entity, share = pie_label(F.col("label"))
    return table(spark, folder, "orders").withColumn("label", label).select("o_orderkey", entity.alias("entity"), F.regexp_extract("label", PIE, 2).cast("double").alias("value"), share.cast("double").alias("share"))


@query("SELECT o_orderkey, o_orderdate + INTERVAL 5 HOUR AS utc, o_orderdate - INTERVAL 5 HOUR AS local, strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS compact FROM orders")
def local_utc(spark, folder):
    at = F.col("o_orderdate").cast("timestamp_ntz")
    return table(spark, folder, "orders").select("o_orderkey", tp.local_to_utc(at).cast("timestamp_ntz").alias("utc"), tp.utc_to_local(at).alias("local"), tp.format_compact(at).alias("compact"))


@query("SELECT event_id, date_trunc('minute', ts) AS label FROM events")
def trend_label_decode(spark, folder):
    """Labels with months from zero, put into points and decoded again."""
    part = lambda f: F.date_part(F.lit(f), "ts").cast("int").cast("string")
    time = F.struct(part("year").alias("y"), (F.month("ts") - 1).cast("string").alias("m"), part("day").alias("d"), part("hour").alias("h"), part("minute").alias("mi"))
    points = table(spark, folder, "events").withColumn("p", F.parse_json(F.to_json(F.struct(time.alias("time")))))
    return points.select("event_id", F.expr(tp.point_label("p", "true")).alias("label"))


# --- unpivots, lookups, exports --------------------------------------------------------------------------------------
@query("SELECT event_id, k AS field, json_extract_string(props, '$.' || k)::DOUBLE AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def json_unpivot(spark, folder):
    each = table(spark, folder, "events").select("event_id", F.explode(F.expr("try_cast(try_parse_json(props) AS map<string, variant>)")).alias("field", "x"))
    return each.select("event_id", "field", F.expr("try_cast(x AS double)").alias("value"))


@query("""SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS field, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS value FROM lineitem""")
def wide_unpivot(spark, folder):
    return table(spark, folder, "lineitem").unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "field", "value")


@query("SELECT stream, field, coalesce(unit, u.v) AS unit, count(*) AS n FROM snapshot_rows LEFT JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in UNITS.items()) + ") u(k, v) ON u.k = stream || '/' || field GROUP BY ALL")
def unit_lookup(spark, folder):
    unit = F.coalesce("unit", F.try_element_at(literal_map(UNITS), F.concat_ws("/", "stream", "field")))
    return table(spark, folder, "snapshot_rows").groupBy("stream", "field", unit.alias("unit")).agg(F.count("*").alias("n"))


@query("SELECT stream, strftime(make_timestamp(epoch_us(timestamp_utc)), '%Y-%m') AS month, year(make_timestamp(epoch_us(timestamp_utc)))::INT AS year, count(*) AS n FROM snapshot_rows GROUP BY ALL")
def export_year_month(spark, folder):
    return with_year(with_month(table(spark, folder, "snapshot_rows"))).groupBy("stream", "month", "year").agg(F.count("*").alias("n"))


@query("""WITH e(stream, field) AS (VALUES ('vert.plant', 'name'), ('vert.plant', 'color'), ('vert.plant', 'cotamax'), ('vert.solar', 'lic'), ('vert.solar', 'mwactual'))
SELECT stream, field FROM e EXCEPT SELECT stream, field FROM register_rows""")
def key_difference(spark, folder):
    """Expected fields that no delivery has."""
    expected = [("vert.plant", "name"), ("vert.plant", "color"), ("vert.plant", "cotamax"), ("vert.solar", "lic"), ("vert.solar", "mwactual")]
    seen = table(spark, folder, "register_rows").select("stream", "field").distinct()
    return spark.createDataFrame(expected, "stream string, field string").join(seen, ["stream", "field"], "left_anti")


@query("""SELECT stream, entity, field, epoch_us(timestamp_utc) AS timestamp_utc, value FROM snapshot_rows WHERE stream = 'sin.data' AND entity = 'Frecuencia' AND value IS NOT NULL""")
def sql_scan(spark, folder):
    """Filters as SQL over a view; they reach the scan."""
    table(spark, folder, "snapshot_rows").createOrReplaceTempView("_snapshots")
    return spark.sql("SELECT stream, entity, field, unix_micros(timestamp_utc) AS timestamp_utc, value FROM _snapshots WHERE stream = 'sin.data' AND entity = 'Frecuencia' AND value IS NOT NULL")

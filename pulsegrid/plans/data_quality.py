"""Queries of problems 1 to 6 over the landing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.exactly_once import DeliveryIndex, arrival_batches
from ..operators.history import version_history
from ..operators.regrid import counter_on_grid, on_grid, uncovered_cells
from ..operators.schema_drift import change_log, consistent_table, shape_changes, type_statistics
from ..operators.snapdiff import changes_by_delivery, snapshot_changes
from ..operators.spikes import flag_implausible
from ..session import prepare, work_path

BATCHES = 3  # p6 takes the landing table in as many batches of arrival


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def p1_flags(spark: SparkSession, folder: str) -> DataFrame:
    return flag_implausible(table(spark, folder, "snapshot_rows"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_flags(spark, folder).select("stream", "entity", "field", "ts_ms")


def p2_changes(spark: SparkSession, folder: str) -> DataFrame:
    changes = snapshot_changes(table(spark, folder, "register_rows"))
    return changes.select("stream", "entity", "field", F.unix_millis("timestamp_utc").alias("ts_ms"), "change_kind", "old_text", "new_text")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_changes(spark, folder).drop("old_text", "new_text")


def p2_by_delivery(spark: SparkSession, folder: str) -> DataFrame:
    return changes_by_delivery(p2_changes(spark, folder), instant="ts_ms")


def trend_minute() -> F.Column:
    """Local minute of a trend row: its label's, else that of its instant at UTC-5 (the session runs in UTC)."""
    label = F.unix_micros(F.col("minute_label_local").cast("timestamp"))
    return F.floor(F.coalesce(label, F.unix_micros("timestamp_utc") - 18_000_000_000) / 60_000_000).cast("long")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "trend_rows").select("entity", trend_minute().alias("cell"), (F.col("value").isNotNull() & ~F.isnan("value")).alias("covered"))
    return uncovered_cells(rows, ("entity",)).select("entity", F.col("cell").alias("minute_local"))


def p3_grid(spark: SparkSession, folder: str) -> DataFrame:
    """One value per local minute: the mean of the minute's samples, each with its last published value."""
    rows = table(spark, folder, "trend_rows").withColumn("cell", trend_minute()).withColumn("seen", F.coalesce("last_seen_update_utc", "first_seen_update_utc"))
    latest = rows.groupBy("entity", "timestamp_utc").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.struct("seen", "first_seen_update_utc", "value"))).alias("value"), F.min("cell").alias("cell"))
    grid = on_grid(latest, ("entity",), F.col("cell"), "value")
    return grid.select("entity", F.timestamp_seconds(F.col("cell") * 60).cast("timestamp_ntz").alias("minute_label_local"), "value", "n_samples", "is_missing")


def p3_counter(spark: SparkSession, folder: str) -> DataFrame:
    """The series read as meters: what each adds per five minutes. Levels that fall count as resets."""
    grid = counter_on_grid(table(spark, folder, "trend_rows"), ("entity",), "timestamp_utc", "value", width_ms=300_000, max_gap_ms=900_000)
    return grid.select("entity", "cell", F.round("value", 3).alias("value"), "covered_ms", "is_missing")


def p4_history(spark: SparkSession, folder: str) -> DataFrame:
    return version_history(table(spark, folder, "trend_rows").withColumn("ts_ms", F.unix_millis("timestamp_utc")), ("entity", "ts_ms"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_history(spark, folder).filter("n_versions >= 2").select("entity", "ts_ms", "from_ms", "to_ms")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return shape_changes(table(spark, folder, "raw_bodies"))


def p5_table(spark: SparkSession, folder: str) -> DataFrame:
    return consistent_table(table(spark, folder, "raw_bodies"))


def p5_types(spark: SparkSession, folder: str) -> DataFrame:
    return type_statistics(table(spark, folder, "raw_bodies"))


def p5_log(spark: SparkSession, folder: str) -> DataFrame:
    return change_log(p5_found(spark, folder))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "snapshot_rows")
    index = DeliveryIndex(spark, work_path(spark, "deliveries"))
    for batch in arrival_batches(rows, BATCHES):
        index.admit(batch)
    return index.dropped()


QUERIES = {f.__name__: f for f in (p1_found, p1_flags, p2_found, p2_changes, p2_by_delivery, p3_found, p3_grid, p3_counter, p4_found, p4_history, p5_found, p5_table, p5_types, p5_log, p6_found)}

_P2 = """
WITH kept AS (
  SELECT stream, timestamp_utc, entity, field, coalesce(trim(value_text, chr(32) || chr(9)), '') AS t
  FROM register_rows WHERE timestamp_utc IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY stream, timestamp_utc, entity, field ORDER BY fetched_at_utc NULLS LAST, chunk NULLS LAST, t) = 1),
deliveries AS (SELECT stream, timestamp_utc, lag(timestamp_utc) OVER (PARTITION BY stream ORDER BY timestamp_utc) AS before FROM (SELECT DISTINCT stream, timestamp_utc FROM kept)),
later AS (SELECT k.*, d.before FROM kept k JOIN deliveries d USING (stream, timestamp_utc) WHERE d.before IS NOT NULL),
earlier AS (SELECT k.stream, d.timestamp_utc, k.entity, k.field, k.t FROM kept k JOIN deliveries d ON k.stream = d.stream AND k.timestamp_utc = d.before),
diff AS (
  SELECT coalesce(l.stream, e.stream) AS stream, coalesce(l.entity, e.entity) AS entity, coalesce(l.field, e.field) AS field, coalesce(l.timestamp_utc, e.timestamp_utc) AS timestamp_utc,
    CASE WHEN e.t IS NULL THEN 'added' WHEN l.t IS NULL THEN 'removed' WHEN l.t <> e.t THEN 'changed' END AS change_kind, e.t AS old_text, l.t AS new_text
  FROM later l FULL JOIN earlier e ON l.stream = e.stream AND l.timestamp_utc = e.timestamp_utc AND l.entity = e.entity AND l.field = e.field)
"""
_P3 = """
WITH cells AS (
  SELECT entity, floor(coalesce(epoch_us(minute_label_local), epoch_us(timestamp_utc) - 18000000000) / 60000000)::BIGINT AS cell, (value IS NOT NULL AND NOT isnan(value)) AS covered, *
  EXCLUDE (entity) FROM trend_rows),
grid AS (SELECT entity, unnest(range(min(cell), max(cell) + 1)) AS cell FROM cells GROUP BY entity)
"""
_P4 = """
WITH seen AS (
  SELECT entity, epoch_us(timestamp_utc) // 1000 AS ts_ms, value, epoch_us(coalesce(first_seen_update_utc, last_seen_update_utc)) // 1000 AS f, epoch_us(coalesce(last_seen_update_utc, first_seen_update_utc)) // 1000 AS l
  FROM trend_rows WHERE value IS NOT NULL AND coalesce(first_seen_update_utc, last_seen_update_utc) IS NOT NULL),
steps AS (SELECT *, lag(value) OVER (PARTITION BY entity, ts_ms ORDER BY f, l, value) IS DISTINCT FROM value AS fresh FROM seen),
versions AS (
  SELECT entity, ts_ms, value, f AS from_ms, coalesce(lead(f) OVER w, -1) AS to_ms, row_number() OVER w AS version, count(*) OVER (PARTITION BY entity, ts_ms) AS n_versions
  FROM steps WHERE fresh WINDOW w AS (PARTITION BY entity, ts_ms ORDER BY f, l, value))
"""
SQL = {
    "p2_found": _P2 + "SELECT stream, entity, field, epoch_us(timestamp_utc) // 1000 AS ts_ms, change_kind FROM diff WHERE change_kind IS NOT NULL",
    "p2_changes": _P2 + "SELECT stream, entity, field, epoch_us(timestamp_utc) // 1000 AS ts_ms, change_kind, old_text, new_text FROM diff WHERE change_kind IS NOT NULL",
    "p2_by_delivery": _P2
    + """SELECT stream, epoch_us(timestamp_utc) // 1000 AS ts_ms, count(*) FILTER (change_kind = 'added') AS added, count(*) FILTER (change_kind = 'removed') AS removed, count(*) FILTER (change_kind = 'changed') AS changed
  FROM diff WHERE change_kind IS NOT NULL GROUP BY ALL""",
    "p3_found": _P3 + "SELECT g.entity, g.cell AS minute_local FROM grid g WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.entity = g.entity AND c.cell = g.cell AND c.covered)",
    "p3_grid": _P3
    + """, latest AS (
  SELECT entity, timestamp_utc, min(cell) AS cell,
    (max(struct_pack(s := coalesce(epoch_us(coalesce(last_seen_update_utc, first_seen_update_utc)), -9000000000000000), f := coalesce(epoch_us(first_seen_update_utc), -9000000000000000), v := value)) FILTER (value IS NOT NULL)).v AS value
  FROM cells GROUP BY entity, timestamp_utc),
held AS (SELECT entity, cell, avg(value) AS value, count(value) AS n FROM latest GROUP BY entity, cell),
edges AS (SELECT entity, unnest(range(min(cell), max(cell) + 1)) AS cell FROM held GROUP BY entity)
SELECT e.entity, make_timestamp(e.cell * 60000000) AS minute_label_local, h.value, coalesce(h.n, 0) AS n_samples, coalesce(h.n, 0) = 0 AS is_missing
FROM edges e LEFT JOIN held h USING (entity, cell)""",
    "p4_found": _P4 + "SELECT entity, ts_ms, from_ms, to_ms FROM versions WHERE n_versions >= 2",
    "p4_history": _P4 + "SELECT entity, ts_ms, version::INTEGER AS version, n_versions::INTEGER AS n_versions, value, from_ms, to_ms FROM versions",
    "p5_types": """
WITH b AS (SELECT DISTINCT endpoint, chunk, fetched_at_utc, body, ltrim(body, chr(65279)) AS text FROM raw_bodies WHERE body IS NOT NULL AND fetched_at_utc IS NOT NULL),
j AS (SELECT *, text::JSON AS js FROM (SELECT * FROM b WHERE json_valid(text)) WHERE json_type(text) = 'OBJECT'),
k AS (SELECT * FROM (SELECT *, unnest(json_keys(js)) AS key FROM j) WHERE key <> 'update'),
v AS (SELECT *, json_extract(js, '$."' || key || '"') AS val FROM k),
r AS (SELECT *, unnest(CASE json_type(val) WHEN 'ARRAY' THEN json_extract(val, '$[*]') WHEN 'OBJECT' THEN [val] ELSE [json_object('value', val)] END) AS rec FROM v),
f AS (SELECT endpoint, chunk, fetched_at_utc, body, key AS path, field, json_extract(rec, '$."' || field || '"') AS x FROM (SELECT *, unnest(json_keys(rec)) AS field FROM r WHERE json_type(rec) = 'OBJECT')),
g AS (SELECT endpoint, chunk, fetched_at_utc, body, path || '.' || field AS path, x, unnest(json_keys(x)) AS field FROM f WHERE json_type(x) = 'OBJECT'),
cells AS (SELECT endpoint, chunk, fetched_at_utc, body, path, field, json_type(x) AS t FROM f WHERE json_type(x) <> 'OBJECT' UNION ALL SELECT endpoint, chunk, fetched_at_utc, body, path, field, json_type(json_extract(x, '$."' || field || '"')) FROM g)
SELECT endpoint, chunk, path, field, count(*) AS n_records, count(*) FILTER (t = 'NULL') AS n_null, count(*) FILTER (t = 'VARCHAR') AS n_string, count(*) FILTER (t IN ('DOUBLE', 'BIGINT', 'UBIGINT', 'HUGEINT', 'UHUGEINT')) AS n_number
FROM cells GROUP BY endpoint, chunk, fetched_at_utc, body, path, field""",
    "p3_counter": """
WITH flat AS (SELECT entity, epoch_us(timestamp_utc) // 1000 AS t, max(value) AS v FROM trend_rows WHERE value IS NOT NULL AND NOT isnan(value) AND timestamp_utc IS NOT NULL GROUP BY ALL),
steps AS (SELECT entity, lag(t) OVER w AS a, t AS b, v, lag(v) OVER w AS pv FROM flat WINDOW w AS (PARTITION BY entity ORDER BY t)),
inc AS (SELECT entity, a, b, CASE WHEN b - a <= 900000 THEN CASE WHEN v < pv THEN v ELSE v - pv END END AS inc FROM steps WHERE a IS NOT NULL),
parts AS (SELECT *, unnest(range(a // 300000, (b - 1) // 300000 + 1)) AS cell FROM inc WHERE inc IS NOT NULL),
shares AS (SELECT entity, cell, inc * (least(b, (cell + 1) * 300000) - greatest(a, cell * 300000)) / (b - a) AS value, least(b, (cell + 1) * 300000) - greatest(a, cell * 300000) AS ms FROM parts),
held AS (SELECT entity, cell, sum(value) AS value, sum(ms) AS covered_ms FROM shares GROUP BY ALL),
grid AS (SELECT entity, unnest(range(min(a) // 300000, (max(b) - 1) // 300000 + 1)) AS cell FROM inc GROUP BY entity)
SELECT g.entity, g.cell, round(h.value, 3) AS value, coalesce(h.covered_ms, 0)::BIGINT AS covered_ms, h.cell IS NULL AS is_missing FROM grid g LEFT JOIN held h ON g.entity = h.entity AND g.cell = h.cell""",
    "p6_found": """SELECT row_id FROM snapshot_rows WHERE timestamp_utc IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY stream, entity, field, epoch_us(timestamp_utc) // 1000 ORDER BY fetched_at_utc NULLS LAST, chunk NULLS LAST, row_id) > 1""",
}

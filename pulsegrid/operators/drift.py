"""Drift of bodies against the expected shape, and the drift log.

Events have (endpoint, path, kind, detail, severity, chunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import mask_digits
from ..functions.values import has_number, is_empty_text
from ..schema import DRIFT_TEXT, EXPECTED, HANDLERS, TREND_NAMES, TREND_POINTS
from .explode import entities, parse_bodies, records, top_level
from .trend import TOLERANCE_S, decode_trends

EVENT = ("endpoint", "path", "kind", "detail", "severity", "chunk")


def _event(cond: Column, path: str | Column, kind: str, detail: Column, severity: str) -> Column:
    """The event if the condition holds, else null; the bodies are parsed once and their events exploded."""
    path = F.lit(path) if isinstance(path, str) else path
    return F.when(cond, F.struct(path.alias("path"), F.lit(kind).alias("kind"), F.substring(detail, 1, 500).alias("detail"), F.lit(severity).alias("severity")))


def _explode(rows: DataFrame, events: Column) -> DataFrame:
    each = rows.select("endpoint", "chunk", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e"))
    return each.select("endpoint", "e.path", "e.kind", "e.detail", "e.severity", "chunk")


def _say(text: str, *values: Column) -> Column:
    """A text of DRIFT_TEXT with its gaps filled."""
    parts = DRIFT_TEXT[text].split("{}")
    filled = [F.lit(parts[0])]
    for value, part in zip(values, parts[1:], strict=True):
        filled += [F.coalesce(value.cast("string"), F.lit("None")), F.lit(part)]
    return F.concat(*filled)


def _names(items: dict[str, tuple[str, ...]]) -> Column:
    return F.create_map(*[x for k, v in items.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])


def body_drift(bodies: DataFrame) -> DataFrame:
    """Drift of whole bodies: invalid JSON, wrong top level, missing and new keys, an update that can't be read."""
    parsed = parse_bodies(bodies)
    is_object = F.col("kind") == "object"
    expected = F.coalesce(F.try_element_at(_names({e: tuple(k) for e, k in EXPECTED.items()}), F.col("endpoint")), F.array().cast("array<string>"))
    missing = F.transform(F.array_except(expected, F.expr("coalesce(map_keys(try_cast(v AS map<string, variant>)), array())")), lambda k: _event(is_object, k, "missing_key", _say("missing_key", k), "ERROR"))
    whole = F.array(
        _event(F.col("kind") == "null", "$", "invalid_json", _say("invalid_json"), "ERROR"),
        _event(~F.col("kind").isin("null", "object"), "$", "type_change", _say("top_type", F.col("kind")), "ERROR"),
        _event(is_object & F.col("update_local").isNull(), "update", "bad_timestamp", _say("bad_update", F.expr("try_variant_get(v, '$.update', 'string')")), "ERROR"),
    )
    known = F.array(*map(F.lit, [*HANDLERS, *(f"{e}.{k}" for e in EXPECTED for k in ("update", "trend"))]))
    unknown = ~F.array_contains(known, F.col("stream")) | ((F.col("stream") == "flow.msg") & (F.col("val_kind") != "object"))
    keys = F.array(
        _event(unknown, F.col("key"), "new_key", _say("new_key", F.col("key"), F.col("val_kind")), "WARN"),
        _event(F.col("handler").isin("name", "pie", "tag", "position", "pair", "fixed") & (F.col("val_kind") != "array"), F.col("stream"), "type_change", _say("list_type", F.col("val_kind")), "ERROR"),
    )
    return _explode(parsed, F.concat(whole, missing)).unionByName(_explode(top_level(parsed), keys))


def record_drift(bodies: DataFrame) -> DataFrame:
    """Drift of records: missing and new fields, entities without key, times and labels that can't be read."""
    named = entities(records(top_level(parse_bodies(bodies))))
    expected = F.try_element_at(_names({f"{e}.{k}": f for e, keys in EXPECTED.items() for k, f in keys.items() if f}), F.col("stream"))
    keys = F.expr("map_keys(m)")
    checked = (F.col("r_kind") == "object") & ~F.col("is_total") & expected.isNotNull()
    plain = lambda kind, severity: (lambda k: F.when(checked, F.struct(F.lit(kind).alias("kind"), k.alias("k"), F.lit(severity).alias("severity"))))
    one = lambda cond, kind, text, severity: F.when(cond, F.struct(F.lit(kind).alias("kind"), text.alias("k"), F.lit(severity).alias("severity")))
    key = F.when(F.col("handler") == "tag", "tag").otherwise("name")
    marks = F.concat(
        F.coalesce(F.transform(F.array_except(expected, keys), plain("missing_field", "WARN")), F.array()),
        F.coalesce(F.transform(F.array_except(keys, expected), plain("new_field", "WARN")), F.array()),
        F.array(
            one(F.col("by_position") & F.col("handler").isin("name", "pie", "tag"), "missing_entity_key", _say("missing_entity_key", F.col("i"), key), "ERROR"),
            one((F.col("handler") == "tag") & F.expr("map_contains_key(m, 'timestamp')") & F.col("scada").isNull(), "bad_timestamp", _say("bad_timestamp", F.col("i"), F.col("scada_text")), "WARN"),
            one(F.col("bad_label"), "label_format", _say("label_format", F.col("label")), "WARN"),
        ),
    )
    each = named.select("endpoint", "chunk", "stream", "n_records", F.explode(F.filter(marks, lambda e: e.isNotNull())).alias("e"))
    # a field counts once per list: in how many records it is missing, or that it is there
    counted = each.groupBy("endpoint", "chunk", "stream", "n_records", "e.kind", "e.k", "e.severity").agg(F.count("*").alias("n"))
    detail = F.when(F.col("kind") == "missing_field", _say("missing_field", F.col("k"), F.col("n"), F.col("n_records"))).when(F.col("kind") == "new_field", _say("new_field", F.col("k"))).otherwise(F.col("k"))
    return counted.select("endpoint", F.col("stream").alias("path"), "kind", F.substring(detail, 1, 500).alias("detail"), "severity", "chunk")


def trend_drift(bodies: DataFrame) -> DataFrame:
    """Drift of trends: names, month convention, labels, values, steps and length."""
    decoded = decode_trends(bodies)
    values = "flatten(transform(filter(arrays_zip(labels, series), p -> p.labels IS NOT NULL), p -> coalesce(try_variant_get(p.series, '$.value', 'array<variant>'), array())))"
    counted = decoded.select(
        "endpoint", "chunk", "names", "base", "gap0", "gap1", "broken",
        F.coalesce(F.size("series"), F.lit(0)).alias("n"), F.expr("try_element_at(labels, -1)").alias("last"), F.filter("labels", lambda x: x.isNotNull()).alias("good"),
        F.expr(f"aggregate({values}, named_struct('e', 0, 'b', 0), (a, x) -> named_struct('e', a.e + CASE WHEN {is_empty_text('x')} THEN 1 ELSE 0 END, 'b', a.b + CASE WHEN NOT {is_empty_text('x')} AND NOT {has_number('x')} THEN 1 ELSE 0 END))").alias("c"),
    )
    counted = counted.withColumn("n", F.greatest("n", F.lit(0))).withColumn("n_bad", F.coalesce("c.b", F.lit(0)) + F.col("n") - F.coalesce(F.size("good"), F.lit(0))).withColumn("n_empty", F.coalesce("c.e", F.lit(0)))
    step = "size(filter(zip_with(slice(good, 1, size(good) - 1), slice(good, 2, size(good) - 1), (a, b) -> timestampdiff(SECOND, a, b) <> 60), x -> x))"
    steps = F.expr(f"CASE WHEN size(good) > 1 THEN {step} ELSE 0 END")
    far = F.coalesce(F.col("gap0"), F.lit(10**9)) > TOLERANCE_S
    near = F.coalesce(F.col("gap1"), F.lit(10**9)) <= TOLERANCE_S
    some, path = (F.col("n") > 0) & ~F.col("broken"), "trend.series"
    events = F.array(
        _event(F.col("broken"), "trend", "parse_error", _say("parse_error"), "ERROR"),
        _event((F.col("n") == 0) & ~F.col("broken"), path, "missing_key", _say("no_series"), "ERROR"),
        _event(some & ~F.coalesce(F.col("names") == F.array(*map(F.lit, TREND_NAMES)), F.lit(False)), "trend.names", "label_change", _say("label_change", F.to_json("names")), "WARN"),
        _event(some & far & near, "trend.series.time", "month_indexing_changed", _say("month_indexing_changed"), "ERROR"),
        _event(some & far & ~near, "trend.series.time", "label_mismatch", _say("label_mismatch", F.col("last"), F.col("base")), "ERROR"),
        _event(some & (F.col("n_bad") > 0), path, "bad_value", _say("bad_value", F.col("n_bad"), F.col("n")), "WARN"),
        _event(some & (F.col("n_empty") > 0), path, "empty_values", _say("empty_values", F.col("n_empty"), F.col("n")), "WARN"),
        _event(some & (F.col("steps") > 0), path, "irregular_step", _say("irregular_step", F.col("steps")), "WARN"),
        _event(some & (F.col("n") != TREND_POINTS), path, "length_change", _say("length_change", F.col("n"), F.lit(TREND_POINTS)), "WARN"),
    )
    return _explode(counted.withColumn("steps", steps), events)


def drift_events(bodies: DataFrame) -> DataFrame:
    """All drift of (endpoint, fetched_at_utc, chunk, body)."""
    return body_drift(bodies).unionByName(record_drift(bodies)).unionByName(trend_drift(bodies))


def drift_rollup(events: DataFrame, per_chunk: bool = False) -> DataFrame:
    """One row per (endpoint, path, kind, pattern): severity and example of the first event by chunk, first and last chunk, number of chunks.

    ``per_chunk`` gives one row per chunk, too.
    """
    keyed = events.withColumn("pattern", mask_digits(F.col("detail")))
    first = F.struct("chunk", "detail")
    return keyed.groupBy("endpoint", "path", "kind", "pattern", *(["chunk"] if per_chunk else [])).agg(
        F.min_by("severity", first).alias("severity"), F.min_by("detail", first).alias("example"), F.min("chunk").alias("first_seen_chunk"), F.max("chunk").alias("last_seen_chunk"), F.count_distinct("chunk").alias("n_chunks")
    )


def upsert_drift_log(log: DataFrame, rollup: DataFrame) -> DataFrame:
    """The log with a rollup merged in: old severity, example and first chunk stay, the last chunk moves on, counts add up.

    Merging the same events twice counts them twice; recompute from events where that matters. Counts that can't be
    read count as 0; null keys are keys.
    """
    count = lambda df, rank: df.select("endpoint", "path", "kind", "pattern", "severity", "example", "first_seen_chunk", "last_seen_chunk", F.coalesce(F.col("n_chunks").try_cast("long"), F.lit(0)).alias("n_chunks"), F.lit(rank).alias("rank"))
    both = count(log, 0).unionByName(count(rollup, 1))
    old = lambda c: F.min_by(c, F.struct("rank", "first_seen_chunk")).alias(c)
    return both.groupBy("endpoint", "path", "kind", "pattern").agg(old("severity"), old("example"), old("first_seen_chunk"), F.max("last_seen_chunk").alias("last_seen_chunk"), F.sum("n_chunks").alias("n_chunks"))


def new_kinds(log: DataFrame, rollup: DataFrame, benign: tuple[str, ...] = ()) -> DataFrame:
    """Rollup rows whose key the log doesn't have, benign kinds left out: what is worth an alert."""
    key = [F.col(f"r.{c}").eqNullSafe(F.col(f"l.{c}")) for c in ("endpoint", "path", "kind", "pattern")]
    return rollup.filter(~F.col("kind").isin(*benign) if benign else F.lit(True)).alias("r").join(log.alias("l"), on=key, how="left_anti")

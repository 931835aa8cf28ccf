"""Table schemas and the fixed values of the source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_OFFSET = "-05:00"  # the wall clock has no daylight saving

_ts, _ntz, _s, _d = T.TimestampType(), T.TimestampNTZType(), T.StringType(), T.DoubleType()


def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in cols.items()])


SNAPSHOT = _struct(timestamp_utc=_ts, timestamp_local=_ntz, stream=_s, entity=_s, field=_s, value=_d, value_text=_s, unit=_s, source_update_utc=_ts, fetched_at_utc=_ts, chunk=_s)
TREND = _struct(timestamp_utc=_ts, timestamp_local=_ntz, stream=_s, entity=_s, field=_s, value=_d, unit=_s, minute_label_local=_ntz, first_seen_update_utc=_ts, last_seen_update_utc=_ts)
LEDGER = _struct(chunk=_s, ingested_at_utc=_s, snapshot_rows=_s, trend_rows=_s, drift_events=_s)
DRIFT_EVENTS = _struct(endpoint=_s, path=_s, kind=_s, pattern=_s, chunk=_s, severity=_s, example=_s)
FETCH_LOG = _struct(chunk=_s, endpoint=_s, status=_d, ok=T.BooleanType(), attempts=_d, bytes=_d, elapsed_s=_d, fetched_at_utc=_s, error=_s)
PROBES = _struct(chunk=_s, endpoint=_s, status=_s, fetched_at_utc=_s)

SNAPSHOT_KEY = ("stream", "entity", "field", "timestamp_utc")
SNAPSHOT_ORDER = ("fetched_at_utc", "chunk")

# Endpoints, and the fields each list of records is known to have. None: no list of records.
ENDPOINTS = ("sin", "gen", "vert", "int", "diagram", "flow")
EXPECTED: dict[str, dict[str, tuple[str, ...] | None]] = {
    "sin": {"data": ("name", "value", "engunit"), "max": ("date", "value", "engunit"), "water": ("name", "value", "hi", "lo", "cu", "cl", "color"), "trend": None, "update": None},
    "gen": {"pie": ("name", "value", "color"), "pie2": ("name", "value", "color"), "unit": ("name", "value", "color"), "update": None},
    "vert": {
        "flow": ("name", "value", "engunit"),
        "plant": ("name", "color", "nactual", "cotamax", "vert", "cons", "mwactual", "agente", "contrato"),
        "solar": ("name", "lic", "mwactual", "agente"),
        "eolica": ("name", "lic", "mwactual", "agente"),
        "final": None,
        "update": None,
    },
    "int": {"nodes": ("from", "to"), "update": None},
    "diagram": {"units": ("tag", "name", "value", "color", "timestamp"), "tooltips": ("tag", "name", "value", "color", "timestamp"), "update": None},
    "flow": {"msg": ("name", "description", "style"), "occi": ("value",), "update": None},
}
# Units that the source doesn't state.
UNITS = {
    "gen.unit/value": "MW", "gen.pie/value": "MW", "gen.pie/share_pct": "%", "gen.pie2/value": "MW", "gen.pie2/share_pct": "%",
    "vert.plant/mwactual": "MW", "vert.plant/contrato": "MW", "vert.solar/mwactual": "MW", "vert.solar/lic": "MW", "vert.eolica/mwactual": "MW", "vert.eolica/lic": "MW", "vert.final/value": "MW",
    "int.nodes/from_mw": "MW", "int.nodes/to_mw": "MW", "int.nodes/from_mvar": "MVAr", "int.nodes/to_mvar": "MVAr", "flow.occi/value": "MW", "sin.trend/value": "MW",
}
# How each list names its entities. Lists that aren't known are "generic".
HANDLERS = {
    "sin.data": "name", "sin.max": "fixed", "sin.water": "name", "gen.pie": "pie", "gen.pie2": "pie", "gen.unit": "name",
    "vert.flow": "name", "vert.plant": "name", "vert.solar": "name", "vert.eolica": "name", "vert.final": "scalar",
    "int.nodes": "pair", "diagram.units": "tag", "diagram.tooltips": "tag", "flow.occi": "position", "flow.msg": "message",
}
TREND_NAMES = ("Generación", "Demanda Real", "Demanda Pronosticada")
TREND_POINTS = 1441
BENIGN_DRIFT = ("irregular_step", "empty_values")
# Wording of drift events. With its digits masked it is part of the drift log's key.
DRIFT_TEXT = {
    "missing_key": "top-level key '{}' missing",
    "missing_field": "'{}' missing in {}/{} records",
    "new_field": "'{}' (parsed as a new field)",
    "missing_entity_key": "record {} has no '{}'; keyed by position",
    "no_series": "trend.series missing or empty",
    "month_indexing_changed": "last trend point only matches `update` with ONE-based months; decoding one-based",
    "bad_value": "{} unparseable points/values of {}",
    "empty_values": "{} empty values of {} points",
    "irregular_step": "{} steps != 1 minute",
    "length_change": "{} points (was {})",
} | {  # own wording: these tell of types and values in JSON's terms
    "invalid_json": "the body can't be read as UTF-8 JSON",
    "top_type": "the body is a JSON {}, no object",
    "bad_update": "no time in update: {}; the fetch time stands in",
    "new_key": "key '{}' isn't known; it holds a JSON {}",
    "list_type": "a list was due, here is a JSON {}",
    "bad_timestamp": "no time in record {}: {}",
    "label_format": "label without amount and share: {}",
    "label_change": "series are named {}",
    "label_mismatch": "the last label is {}, the update {}; neither month convention fits",
    "parse_error": "the trend isn't made of points with lists of values",
}


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns: others are dropped, missing ones null, failed casts null, instants in milliseconds.

    ``timestamp_local`` is always derived from ``timestamp_utc``.
    """

    def column(f: T.StructField):
        if f.name == "timestamp_local" and "timestamp_utc" in rows.columns:
            return F.date_trunc("MILLISECOND", F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_OFFSET), F.col("timestamp_utc").cast("timestamp_ntz"))).cast("timestamp_ntz").alias(f.name)
        c = (F.col(f.name) if f.name in rows.columns else F.lit(None).cast("string")).try_cast(f.dataType)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_trunc("MILLISECOND", c).cast(f.dataType)
        return c.alias(f.name)

    return rows.select(*[column(f) for f in schema.fields])

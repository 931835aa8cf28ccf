import json
from datetime import datetime, timedelta, timezone

from helpers import rows

from pulsegrid.operators.schema_drift import body_cells, change_log, consistent_table, shape_changes, type_statistics

T0 = datetime(2026, 1, 5, tzinfo=timezone.utc)
SCHEMA = "chunk string, endpoint string, fetched_at_utc timestamp, body string, v string"


def frame(spark, bodies, endpoint="e"):
    """Bodies in order; objects are written as JSON."""
    return spark.createDataFrame([(f"c{i}", endpoint, T0 + timedelta(hours=7 * i), b if b is None or isinstance(b, str) else json.dumps(b), "x") for i, b in enumerate(bodies)], SCHEMA)


def found(spark, bodies):
    return [r[1:] for r in rows(shape_changes(frame(spark, bodies)))]


def items(**fields):
    return [{"name": f"n{i}", **{k: (v(i) if callable(v) else v) for k, v in fields.items()}} for i in range(6)]


def test_fields_types_and_keys(spark):
    a = {"update": "x", "list": items(value=lambda i: 10.0 * i + 5, color="rojo")}
    b = {"update": "y", "list": items(value=lambda i: str(10.0 * i + 5), color="rojo", nota="hola"), "extra": [{"name": "q", "w": 1}]}
    assert found(spark, [a, b]) == [("extra", "new_key", "extra", "c1"), ("list", "new_field", "nota", "c1"), ("list", "type_change", "value", "c1")]
    assert found(spark, [b, a]) == [("extra", "missing_key", "extra", "c1"), ("list", "missing_field", "nota", "c1"), ("list", "type_change", "value", "c1")]


def test_renames_go_on_with_the_values(spark):
    a = {"list": items(value=lambda i: 50.0 * i + 20, color=lambda i: f"c{i}")}
    renamed = {"list": items(valor=lambda i: str(50.0 * i + 21), color=lambda i: f"c{i}")}
    swapped = {"list": items(nota=lambda i: f"NOTA {i}", color=lambda i: f"c{i}")}
    assert found(spark, [a, renamed]) == [("list", "renamed_field", "value>valor", "c1")]
    assert found(spark, [a, swapped]) == [("list", "missing_field", "value", "c1"), ("list", "new_field", "nota", "c1")]


def test_sub_objects_and_what_does_not_count(spark):
    node = lambda **f: {"nodes": [{"from": {"name": f"a{i}", **f}, "to": {"name": f"b{i}", "mw": 1}} for i in range(4)]}
    bodies = [node(mw=1), "﻿" + json.dumps(node(mw=None)), "{broken", None, "", node(mw=2), {"nodes": []}]
    assert found(spark, [*bodies[:6]]) == []
    assert found(spark, [node(mw=1), "nope", node(mw=1, mvar=2)]) == [("nodes.from", "new_field", "mvar", "c2")]
    assert found(spark, [node(mw=1), {"other": []}]) == [("nodes", "missing_key", "nodes", "c1"), ("other", "new_key", "other", "c1")]
    assert found(spark, ["[1, 2]", node(mw=1)]) == [("nodes", "new_key", "nodes", "c1")]


def test_order_repeats_and_empty(spark):
    a, b = {"l": items(x=1)}, {"l": items(x=1, y=2)}
    df = frame(spark, [a, b])
    assert rows(shape_changes(df.unionByName(df).orderBy("body", ascending=False))) == [("e", "l", "new_field", "y", "c1")]
    assert shape_changes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows(change_log(shape_changes(df))) == [("e", "l", "new_field", "y", "c1", "c1", 1)]


def test_typed_table_reports_failed_casts(spark):
    df = frame(spark, [{"l": [{"tag": "t", "name": "n", "x": "1,040.82"}, {"name": "m", "x": 7}, {"x": "N/D"}, {"name": "k", "x": None}]}])
    out = consistent_table(df).filter("field = 'x'")
    assert rows(out, "entity", "value", "value_text", "cast_failed") == [("#2", None, "N/D", True), ("k", None, None, False), ("m", 7.0, None, False), ("t", 1040.82, None, False)]
    assert rows(type_statistics(df).filter("field = 'x'"), "n_records", "n_null", "n_string", "n_number") == [(4, 1, 2, 1)]
    assert body_cells(df.filter("false")).count() == 0


def brute(records):
    """The definition, in plain Python, without renames."""

    def shape(o):
        out = {}
        for k, v in o.items():
            if k == "update":
                continue
            own = out.setdefault(k, {})
            for r in v if isinstance(v, list) else []:
                for f, x in r.items():
                    fields = out.setdefault(f"{k}.{f}", {}) if isinstance(x, dict) else own
                    for g, y in (x if isinstance(x, dict) else {f: x}).items():
                        kinds = fields.setdefault(g, set())
                        if y is not None:
                            kinds.add("string" if isinstance(y, str) else "number")
        return out

    events, before = [], {}
    for chunk, endpoint, _, body in records:
        try:
            now = shape(json.loads(body.lstrip("﻿")))
        except (ValueError, AttributeError):
            continue
        old = before.get(endpoint)
        before[endpoint] = now
        if old is None:
            continue
        events += [(endpoint, k, "new_key", k, chunk) for k in now.keys() - old.keys()] + [(endpoint, k, "missing_key", k, chunk) for k in old.keys() - now.keys()]
        for k in now.keys() & old.keys():
            events += [(endpoint, k, "new_field", f, chunk) for f in now[k].keys() - old[k].keys()] + [(endpoint, k, "missing_field", f, chunk) for f in old[k].keys() - now[k].keys()]
            events += [(endpoint, k, "type_change", f, chunk) for f in now[k].keys() & old[k].keys() if now[k][f] and old[k][f] and now[k][f] != old[k][f]]
    return events


def test_test_tables_against_brute_force(spark, data):
    df = spark.read.parquet(f"{data}/raw_bodies.parquet")
    records = sorted(((r.chunk, r.endpoint, r.fetched_at_utc, r.body) for r in df.select("chunk", "endpoint", "fetched_at_utc", "body").distinct().collect()), key=lambda r: (r[2], r[0]))
    expected = set(brute(records))
    out = set(map(tuple, shape_changes(df).collect()))
    for e, p, kind, pattern, c in [x for x in out if x[2] == "renamed_field"]:
        was, now = pattern.split(">")
        out -= {(e, p, kind, pattern, c)}
        out |= {(e, p, "missing_field", was, c), (e, p, "new_field", now, c)}
    assert out == expected

"""Schemas that drift between files.

Method: each body becomes a map of paths to values with their raw types, the cells. Cells give path-type statistics by
body, from which each body's shape is compared with the one before, and a typed projection that reports failed casts.
A body is parsed and walked once per use, in Arrow batches, and a value's type is looked at once. Only a digest of each
shape goes through the ordering of an endpoint's bodies; the few different shapes are met again where it changes.

Paths: ``plant`` is a list of records or a single record, ``nodes.from`` a sub-object of its records; ``depth`` says how
many levels of sub-objects are paths of their own; a key with a bare value has the one field ``value``. Objects and lists below that, and lists within records, are values:
their types count, what is inside them doesn't (``path_report`` lists them).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import number_of
from ..session import cut, prepare, store
from .ordering import with_previous

ENTITY = ("tag", "name")  # the fields that name an entity, the first that is there counts
SKIP = ("update",)  # keys of a body that aren't data
DEPTH = 1
_CELL = pa.struct([("path", pa.string()), ("entity", pa.string()), ("field", pa.string()), ("raw_type", pa.string()), ("text", pa.string())])
_FIELD = pa.struct([("path", pa.string()), ("field", pa.string())])
_TYPE = pa.struct([("path", pa.string()), ("field", pa.string()), ("raw_type", pa.string())])
_SHAPE_DDL = "keys array<string>, fields array<struct<path:string,field:string>>, types array<struct<path:string,field:string,raw_type:string>>"
_CELL_DDL = "cells array<struct<path:string,entity:string,field:string,raw_type:string,text:string>>"
_KINDS = {str: "string", bool: "boolean", int: "number", float: "number", dict: "object", list: "array"}


def _refuse(constant: str):
    raise ValueError(constant)


def parse(body: str | None):
    """The JSON value of a body, or None if it has none; a leading byte order mark doesn't matter, NaN is no JSON."""
    try:
        return json.loads(body.removeprefix("\ufeff"), parse_constant=_refuse) if body is not None else None
    except (ValueError, RecursionError):
        return None


def _text(v) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def walk(value, entity: tuple[str, ...], skip: tuple[str, ...], depth: int) -> Iterator[tuple]:
    """(path, entity, field, value) of every cell, and (path, None, None, None) for every key and sub-object."""

    def record(path: str, r: dict, i: int, level: int) -> Iterator[tuple]:
        named = next((r[k] for k in entity if isinstance(r.get(k), (str, int, float))), None)
        name = f"#{i}" if named is None else named if isinstance(named, str) else json.dumps(named)
        for f, x in r.items():
            if isinstance(x, dict) and level < depth:
                yield f"{path}.{f}", None, None, None
                yield from record(f"{path}.{f}", x, i, level + 1)
            else:
                yield path, name, f, x

    for key, v in value.items() if isinstance(value, dict) else ():
        if key in skip:
            continue
        yield key, None, None, None
        if not isinstance(v, (dict, list)):
            yield key, "#0", "value", v
        for i, r in enumerate([v] if isinstance(v, dict) else v if isinstance(v, list) else ()):
            if isinstance(r, dict):
                yield from record(key, r, i, 0)


def _shapes(entity, skip, depth):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, fields, types = [], [], [], []
            for i, body in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                value = parse(body)
                if value is None:
                    continue
                k, f, t = set(), set(), set()
                for path, _, field, x in walk(value, entity, skip, depth):
                    if field is None:
                        k.add(path)
                    else:
                        f.add((path, field))
                        if x is not None:
                            t.add((path, field, _KINDS[type(x)]))
                ids.append(i)
                keys.append(sorted(k))
                fields.append([{"path": a, "field": b} for a, b in sorted(f)])
                types.append([{"path": a, "field": b, "raw_type": c} for a, b, c in sorted(t)])
            kept = batch.take(pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array(keys, pa.list_(pa.string())), pa.array(fields, pa.list_(_FIELD)), pa.array(types, pa.list_(_TYPE))], names=[*batch.schema.names[:-1], "keys", "fields", "types"])

    return run


def _cells(entity, skip, depth):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cells = [], []
            for i, body in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                value = parse(body)
                if value is None:
                    continue
                ids.append(i)
                cells.append([{"path": p, "entity": e, "field": f, "raw_type": _KINDS.get(type(x)), "text": _text(x)} for p, e, f, x in walk(value, entity, skip, depth) if f is not None])
            kept = batch.take(pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array(cells, pa.list_(_CELL))], names=[*batch.schema.names[:-1], "cells"])

    return run


def _mapped(rows: DataFrame, run, ddl: str) -> DataFrame:
    """Replace the last column, the body, by what ``run`` makes of it."""
    return rows.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[:-1]) + f", {ddl}")


def body_cells(bodies: DataFrame, body: str = "body", *, entity: tuple[str, ...] = ENTITY, skip: tuple[str, ...] = SKIP, depth: int = DEPTH) -> DataFrame:
    """Replace ``body`` by ``cells`` (path, entity, field, raw_type, text); bodies without valid JSON are left out.

    A leading byte order mark doesn't matter. An entity is named by the first of ``entity`` that it has, else by its
    position. Valid JSON that isn't an object, or null, has no cells. A null has no raw type and no text.
    """
    return _mapped(bodies.select(*[c for c in bodies.columns if c != body], body), _cells(entity, skip, depth), _CELL_DDL)


def _identified(bodies: DataFrame) -> DataFrame:
    """Bodies with ``bid``, the digest of all that tells one delivery from another; the body stays last."""
    prepare(bodies.sparkSession)
    bid = F.sha2(F.concat_ws("\u0001", F.coalesce("endpoint", F.lit("\u0002")), F.coalesce("chunk", F.lit("\u0002")), F.unix_micros("fetched_at_utc").cast("string"), F.sha2("body", 256)), 256)
    return bodies.filter("fetched_at_utc is not null and body is not null").select("endpoint", "chunk", "fetched_at_utc", bid.alias("bid"), "body")


def _once(rows: DataFrame) -> DataFrame:
    """Repeated deliveries of one body count once."""
    return rows.dropDuplicates(["bid"])


def type_statistics(bodies: DataFrame, **how) -> DataFrame:
    """Path-type statistics by body: ``endpoint``, ``chunk``, ``path``, ``field``, ``n_records``, ``n_null``, ``n_string``, ``n_number``."""
    cells = body_cells(_once(_identified(bodies)), **how).select("endpoint", "chunk", "bid", F.explode("cells").alias("c"))
    of = lambda kind: F.count_if(F.col("c.raw_type") == kind)
    return cells.groupBy("endpoint", "chunk", "bid", F.col("c.path").alias("path"), F.col("c.field").alias("field")).agg(
        F.count("*").alias("n_records"), F.count_if(F.col("c.raw_type").isNull()).alias("n_null"), of("string").alias("n_string"), of("number").alias("n_number")
    ).drop("bid")


def path_report(bodies: DataFrame, **how) -> DataFrame:
    """(endpoint, path, field, n): the fields that hold objects or lists, whose inside isn't looked at."""
    cells = body_cells(_once(_identified(bodies)), **how).select("endpoint", F.explode("cells").alias("c")).filter("c.raw_type in ('object', 'array')")
    return cells.groupBy("endpoint", F.col("c.path").alias("path"), F.col("c.field").alias("field")).agg(F.count("*").alias("n"))


def consistent_table(bodies: DataFrame, **how) -> DataFrame:
    """All bodies as one typed table; ``cast_failed`` marks texts of a mostly numeric field that are no number.

    A field is numeric if most of its non-null values, over all bodies, are numbers or texts of numbers.
    """
    cells = body_cells(_once(_identified(bodies)), **how).select("endpoint", "chunk", "fetched_at_utc", F.explode("cells").alias("c")).select("endpoint", "chunk", "fetched_at_utc", "c.*")
    text = F.col("text")
    number = F.when(F.col("raw_type") == "number", text.try_cast("double")).when((F.col("raw_type") == "string") & ~F.rtrim(text).endswith("%"), number_of(text))
    cells = store(cells.withColumn("value", number))
    kinds = cells.groupBy("endpoint", "path", "field").agg((F.count("value") * 2 > F.count("text")).alias("is_numeric"))
    c, k = cells.alias("c"), kinds.alias("k")
    met = c.join(k, on=[F.col(f"c.{x}").eqNullSafe(F.col(f"k.{x}")) for x in ("endpoint", "path", "field")]).select("c.*", "k.is_numeric")
    return met.select(
        "endpoint", "chunk", "fetched_at_utc", "path", "entity", "field", "raw_type", F.when(F.col("is_numeric"), F.col("value")).alias("value"),
        F.when(~F.col("is_numeric") | F.col("value").isNull(), F.col("text")).alias("value_text"), (F.col("is_numeric") & F.col("value").isNull() & F.col("text").isNotNull()).alias("cast_failed"),
    )


def shape_changes(bodies: DataFrame, *, close: float = 0.25, share: float = 0.7, **how) -> DataFrame:
    """Columns ``endpoint``, ``path``, ``kind``, ``pattern``, ``chunk``: changes of shape between successive bodies.

    Bodies of an endpoint follow each other by ``fetched_at_utc`` (then ``chunk``); invalid JSON, null bodies and rows
    without fetch time are left out. Kinds: ``new_key``, ``missing_key``, ``new_field``, ``missing_field``,
    ``type_change`` and ``renamed_field``. A field that vanishes while another appears is renamed if for at least
    ``share`` of the entities with both values the new one goes on from the old: equal text, or numbers that differ by
    at most ``close`` of the larger. Of several such partners the best fitting counts.
    """
    entity, skip, depth = (how.get(k, d) for k, d in (("entity", ENTITY), ("skip", SKIP), ("depth", DEPTH)))
    rows = _identified(bodies)
    digest = F.sha2(F.to_json(F.struct("keys", "fields", "types")), 256)
    shaped = store(_mapped(rows, _shapes(entity, skip, depth), _SHAPE_DDL).withColumn("shape", digest))
    shapes = shaped.groupBy("shape").agg(*[F.first(c).alias(c) for c in ("keys", "fields", "types")])
    day = F.floor(F.unix_micros("fetched_at_utc") / 86_400_000_000).cast("long")
    slim = _once(shaped.select("endpoint", "chunk", "fetched_at_utc", "bid", F.struct("bid", "shape").alias("me")))
    turns = with_previous(slim, ("endpoint",), day, ("fetched_at_utc", "chunk", "bid"), "me", "old").filter("old is not null and old.shape <> me.shape")
    turns = cut(turns.select("endpoint", "chunk", "bid", F.col("me.shape").alias("shape"), F.col("old.bid").alias("old_bid"), F.col("old.shape").alias("old_shape")))

    # each different pair of shapes is compared once, however often it comes
    side = lambda c, name: shapes.select(F.col("shape").alias(c), F.struct("keys", "fields", "types").alias(name))
    kinds = turns.select("shape", "old_shape").distinct().join(side("shape", "now"), "shape").join(side("old_shape", "old"), "old_shape")
    both = "array_intersect(now.keys, old.keys)"
    top = "x -> NOT contains(x, '.') OR array_contains({}, regexp_replace(x, '[.][^.]*$', ''))"  # a vanished list takes its sub-objects along
    kinds = kinds.select(
        "shape", "old_shape",
        F.expr("filter(array_except(now.keys, old.keys), " + top.format("old.keys") + ")").alias("new_keys"),
        F.expr("filter(array_except(old.keys, now.keys), " + top.format("now.keys") + ")").alias("lost_keys"),
        F.expr(f"filter(array_except(now.fields, old.fields), f -> array_contains({both}, f.path))").alias("new_fields"),
        F.expr(f"filter(array_except(old.fields, now.fields), f -> array_contains({both}, f.path))").alias("lost_fields"),
        F.expr("array_distinct(transform(filter(concat(array_except(now.types, old.types), array_except(old.types, now.types)), t -> exists(now.types, n -> n.path = t.path AND n.field = t.field) AND exists(old.types, o -> o.path = t.path AND o.field = t.field)), t -> struct(t.path AS path, t.field AS field)))").alias("retyped"),
    ).filter("size(new_keys) + size(lost_keys) + size(new_fields) + size(lost_fields) + size(retyped) > 0")
    kinds = kinds.withColumn("swaps", F.expr("filter(flatten(transform(lost_fields, l -> transform(new_fields, n -> struct(l.path AS path, n.path AS other, l.field AS was, n.field AS is)))), s -> s.path = s.other)"))
    pairs = cut(turns.join(kinds, ["shape", "old_shape"]).drop("shape", "old_shape"))  # the few bodies whose shape changed

    swaps = pairs.select("bid", "old_bid", F.explode("swaps").alias("s")).select("bid", "old_bid", "s.path", "s.was", "s.is")
    wanted = swaps.select(F.explode(F.array("bid", "old_bid")).alias("bid")).distinct()
    values = body_cells(_once(rows.join(wanted, "bid", "left_semi").select("bid", "body")), **how).select("bid", F.explode("cells").alias("c")).select("bid", "c.path", "c.field", "c.entity", "c.text")
    values = cut(values.filter("text is not null").groupBy("bid", "path", "field", "entity").agg(F.min("text").alias("text")))  # met twice, as the new and as the old side
    after = swaps.join(values.withColumnRenamed("field", "is").withColumnRenamed("text", "b"), ["bid", "path", "is"])
    before = values.withColumnRenamed("bid", "old_bid").withColumnRenamed("field", "was").withColumnRenamed("text", "a")
    a, b = F.expr("try_cast(a AS double)"), F.expr("try_cast(b AS double)")
    alike = F.coalesce(F.abs(a - b) <= close * F.greatest(F.abs(a), F.abs(b)), F.col("a") == F.col("b"))
    fit = after.join(before, ["old_bid", "path", "was", "entity"]).groupBy("bid", "path", "was", "is").agg(F.avg(alike.cast("double")).alias("score"), F.count("*").alias("n")).filter(F.col("score") >= share)
    rank = lambda own, other: F.row_number().over(Window.partitionBy("bid", "path", own).orderBy(F.desc("score"), F.desc("n"), other))
    renames = fit.withColumn("r1", rank("was", "is")).withColumn("r2", rank("is", "was")).filter("r1 = 1 AND r2 = 1").groupBy("bid").agg(F.collect_list(F.struct("path", "was", "is")).alias("renames"))

    log = pairs.join(renames, "bid", "left").withColumn("renames", F.coalesce("renames", F.expr("array()").cast("array<struct<path:string,was:string,is:string>>")))
    item = "named_struct('path', {}, 'kind', '{}', 'pattern', {})"
    changes = "concat(" + ", ".join((
        "transform(new_keys, k -> " + item.format("k", "new_key", "k") + ")",
        "transform(lost_keys, k -> " + item.format("k", "missing_key", "k") + ")",
        "transform(filter(new_fields, f -> NOT exists(renames, r -> r.path = f.path AND r.is = f.field)), f -> " + item.format("f.path", "new_field", "f.field") + ")",
        "transform(filter(lost_fields, f -> NOT exists(renames, r -> r.path = f.path AND r.was = f.field)), f -> " + item.format("f.path", "missing_field", "f.field") + ")",
        "transform(retyped, f -> " + item.format("f.path", "type_change", "f.field") + ")",
        "transform(renames, r -> " + item.format("r.path", "renamed_field", "concat(r.was, '>', r.is)") + ")",
    )) + ")"
    return log.select("endpoint", "chunk", F.explode(F.expr(changes)).alias("c")).select("endpoint", "c.path", "c.kind", "c.pattern", "chunk")


def change_log(changes: DataFrame) -> DataFrame:
    """Changes rolled up to one row per (endpoint, path, kind, pattern), digits masked, with first and last chunk."""
    masked = changes.withColumn("pattern", F.regexp_replace("pattern", r"\d+", "#"))
    return masked.groupBy("endpoint", "path", "kind", "pattern").agg(F.min("chunk").alias("first_seen_chunk"), F.max("chunk").alias("last_seen_chunk"), F.count_distinct("chunk").alias("n_chunks"))

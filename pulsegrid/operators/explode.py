"""Bodies of changing shape to long rows: one row per (instant, stream, entity, field).

Bodies are parsed once into VARIANT; every step is a column expression, and nothing raises: what doesn't fit becomes
null here and a drift event in ``drift``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import local_to_utc, scada_ts, spanish_ts
from ..functions.values import json_type, json_value, pie_label, strip
from ..schema import HANDLERS, SNAPSHOT, UNITS, conform
from ..session import prepare


def literal_map(items: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in items.items() for x in kv])


def parse_bodies(bodies: DataFrame) -> DataFrame:
    """Add ``v`` (variant, null if the body, text or bytes, is no JSON in UTF-8), ``kind``, ``update_local`` and ``update_utc``. Expects endpoint, body, fetched_at_utc, chunk."""
    prepare(bodies.sparkSession)
    text = "CAST(body AS string)"
    parsed = bodies.withColumn("v", F.expr(f"try_parse_json(CASE WHEN is_valid_utf8({text}) THEN regexp_replace({text}, '^\\\\uFEFF', '') END)")).withColumn("kind", F.expr(json_type("v")))
    local = spanish_ts(F.expr("CASE WHEN kind = 'object' THEN try_variant_get(v, '$.update', 'string') END"))
    return parsed.withColumn("update_local", local).withColumn("update_utc", local_to_utc(F.col("update_local")))


def top_level(parsed: DataFrame) -> DataFrame:
    """One row per top-level key but ``update`` and ``trend``: ``key``, ``val``, ``val_kind``, ``stream``, ``handler``."""
    entries = parsed.filter("kind = 'object'").select("*", F.explode(F.expr("try_cast(v AS map<string, variant>)")).alias("key", "val")).filter("key not in ('update', 'trend')")
    stream = F.concat_ws(".", "endpoint", "key")
    known = F.coalesce(F.try_element_at(literal_map(HANDLERS), stream), F.lit("generic"))
    with_kind = entries.drop("v", "body").withColumn("val_kind", F.expr(json_type("val"))).withColumn("stream", stream).withColumn("handler", known)
    # a message that is no object and an unknown list or scalar go the generic way
    return with_kind.withColumn("handler", F.when((F.col("handler") == "message") & (F.col("val_kind") != "object"), "generic").otherwise(F.col("handler")))


def records(top: DataFrame) -> DataFrame:
    """One row per record: ``i``, ``r``, ``r_kind``, ``m`` (its fields), ``n_records``; scalars are their own record."""
    items = "try_cast(val AS array<variant>)"
    generic = f"size({items}) > 0 AND forall({items}, x -> schema_of_variant(x) LIKE 'OBJECT%')"
    chosen = F.expr(
        f"""CASE WHEN handler IN ('scalar', 'message') THEN array(val) WHEN handler = 'generic' AND val_kind NOT IN ('array', 'object') THEN array(val)
        WHEN handler = 'generic' AND val_kind = 'array' AND {generic} THEN {items} WHEN handler <> 'generic' AND val_kind = 'array' THEN {items} END"""
    )
    named = F.expr(f"handler = 'generic' AND val_kind = 'array' AND forall({items}, x -> try_variant_get(x, '$.name', 'variant') IS NOT NULL)")
    each = top.withColumn("_all", chosen).withColumn("all_named", named).select("*", F.size("_all").alias("n_records"), F.posexplode("_all").alias("i", "r")).drop("_all", "val")
    return each.withColumn("r_kind", F.expr(json_type("r"))).withColumn("m", F.expr("CASE WHEN r_kind = 'object' THEN try_cast(r AS map<string, variant>) END")).withColumn("is_total", F.expr("coalesce(map_keys(m) = array('Total'), false)"))


def entities(recs: DataFrame) -> DataFrame:
    """Add ``label`` (the entity as given), ``entity``, ``share`` (of pies), ``by_position``, ``unit_given``, ``scada``."""
    get = lambda k: F.expr(f"try_cast(m['{k}'] AS string)")
    name_of = lambda side: F.coalesce(strip(F.expr(f"try_variant_get(m['{side}'], '$.name', 'string')")), F.lit("?"))
    key = F.when(F.col("handler") == "tag", get("tag")).when(F.col("handler").isin("name", "pie"), get("name")).when(F.col("all_named"), get("name"))
    keyed = F.col("handler").isin("tag", "name", "pie")
    numbered = F.concat(F.lit("#"), F.col("i").cast("string"))
    position = F.concat(F.when(F.col("handler") == "position", F.col("key")).otherwise(F.col("endpoint")), F.lit("["), F.col("i").cast("string"), F.lit("]"))
    label = (
        F.when(F.col("handler") == "message", F.lit("msg"))
        .when(F.col("handler") == "scalar", F.col("key"))
        .when((F.col("handler") == "generic") & F.col("val_kind").isin("string", "number", "boolean", "null"), F.col("key"))
        .when(F.col("r_kind") != "object", F.concat(F.lit("["), F.col("i").cast("string"), F.lit("]")))
        .when(F.col("is_total"), F.lit("Total"))
        .when(F.col("handler") == "fixed", F.lit("SIN"))
        .when(F.col("handler") == "pair", F.concat(name_of("from"), F.lit(" -> "), name_of("to")))
        .when(F.col("handler") == "position", position)
        .when(keyed | F.col("all_named"), F.coalesce(key, numbered))
        .otherwise(position)
    )
    record = (F.col("r_kind") == "object") & ~F.col("is_total") & (F.col("handler") != "message")
    has_key = F.expr("CASE WHEN handler = 'tag' THEN map_contains_key(m, 'tag') WHEN handler IN ('name', 'pie') THEN map_contains_key(m, 'name') ELSE true END")
    matches, entity, share = pie_label(F.col("label"))
    is_pie = (F.col("handler") == "pie") & record
    out = recs.withColumn("label", label).withColumn("is_record", record).withColumn("by_position", record & ~has_key)
    return (
        out.withColumn("entity", F.when(is_pie & matches, entity).otherwise(F.col("label")))
        .withColumn("share", F.when(is_pie & matches, share))
        .withColumn("bad_label", is_pie & ~matches)
        .withColumn("unit_given", F.when(record, get("engunit")))
        .withColumn("scada_text", F.when(record & (F.col("handler") == "tag"), get("timestamp")))
        .withColumn("scada", scada_ts(F.col("scada_text")))
    )


def snapshot_rows(bodies: DataFrame) -> DataFrame:
    """Rows of the SNAPSHOT schema from (endpoint, fetched_at_utc, chunk, body).

    The instant is the record's own time, else the body's ``update``, else the fetch. Values that are null in the body
    give no row, empty texts do. Bodies that are no JSON object give none.
    """
    named = entities(records(top_level(parse_bodies(bodies))))
    null_variant = "CAST(NULL AS variant)"
    gone = "CASE handler WHEN 'tag' THEN array('engunit', 'tag', 'timestamp') WHEN 'name' THEN array('engunit', 'name') WHEN 'pie' THEN array('engunit', 'name') WHEN 'message' THEN array() ELSE CASE WHEN all_named THEN array('engunit', 'name') ELSE array('engunit') END END"
    nested = "transform(filter(map_entries(try_cast(e.value AS map<string, variant>)), s -> s.key <> 'name'), s -> named_struct('field', concat(e.key, '_', s.key), 'x', s.value, 'nested', true))"
    fields = f"""CASE
        WHEN r_kind <> 'object' OR handler = 'scalar' THEN array(named_struct('field', 'value', 'x', r, 'nested', false))
        WHEN is_total THEN array(named_struct('field', 'value', 'x', m['Total'], 'nested', false))
        ELSE flatten(transform(filter(map_entries(m), e -> NOT array_contains({gone}, e.key)),
            e -> CASE WHEN handler <> 'message' AND schema_of_variant(e.value) LIKE 'OBJECT%' THEN {nested} ELSE array(named_struct('field', e.key, 'x', e.value, 'nested', false)) END)) END"""
    share = f"CASE WHEN share IS NULL THEN array() ELSE array(named_struct('field', 'share_pct', 'x', coalesce(try_parse_json(concat('\"', share, '\"')), {null_variant}), 'nested', true)) END"
    cells = named.select("*", F.explode(F.expr(f"concat({fields}, {share})")).alias("c")).select("*", "c.field", "c.x", "c.nested")
    value, text = json_value("x")
    megawatt_tag = F.col("stream").startswith("diagram.") & F.upper("entity").contains("MW")
    own_unit = F.when(F.col("is_total"), "MW").when((F.col("field") == "value") & ~F.col("nested") & F.col("is_record"), F.coalesce(F.col("unit_given"), F.when(megawatt_tag, "MW")))
    unit = F.coalesce(F.nullif(own_unit, F.lit("")), F.try_element_at(literal_map(UNITS), F.concat_ws("/", "stream", "field")))
    at = F.coalesce(local_to_utc(F.col("scada")), F.col("update_utc"), F.col("fetched_at_utc"))
    rows = cells.select(
        at.alias("timestamp_utc"), "stream", "entity", "field", value.alias("value"), text.alias("value_text"), unit.alias("unit"), F.col("update_utc").alias("source_update_utc"), "fetched_at_utc", "chunk"
    )
    return conform(rows.filter("value is not null or value_text is not null"), SNAPSHOT)




"""Queries of problems 7 to 9 over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, prepare
from .packing import document_sizes, pack_documents, packing_faults, unused_space
from .tokens import decode_ids, encode_corpus
from .truncation import field_limits, find_truncated, truncation_report


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(_table(spark, folder, "documents"))


def p7_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the texts that the ids decode to."""
    return decode_ids(p7_ids(spark, folder)).select("doc_id", F.md5(F.encode("text", "utf-8")).alias("digest"), F.char_length("text").alias("n_chars"))


def p7_tokens_by_source(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    sizes = document_sizes(docs)
    return docs.select("doc_id", "source").join(sizes, "doc_id").groupBy("source").agg(F.count("*").alias("n_documents"), F.sum("n_tokens").alias("n_tokens"), F.max("n_tokens").alias("most_tokens"))


def p8_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(document_sizes(_table(spark, folder, "documents")), _table(spark, folder, "pack_sizes"))


def p8_valid(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of the packing, none of which there may be."""
    sizes, capacities = cut(document_sizes(_table(spark, folder, "documents"))), _table(spark, folder, "pack_sizes")
    return packing_faults(pack_documents(sizes, capacities), sizes, capacities)


def p8_unused(spark: SparkSession, folder: str) -> DataFrame:
    return unused_space(p8_pack(spark, folder), _table(spark, folder, "pack_sizes"))


def p9_flags(spark: SparkSession, folder: str) -> DataFrame:
    return find_truncated(_table(spark, folder, "documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_flags(spark, folder).filter("is_cut").select("doc_id")


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    return truncation_report(p9_flags(spark, folder))


def p9_limits(spark: SparkSession, folder: str) -> DataFrame:
    return field_limits(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p7_ids, p7_round_trip, p7_tokens_by_source, p8_pack, p8_valid, p8_unused, p9_found, p9_flags, p9_report, p9_limits)}

_BIN = 8
SQL: dict[str, str] = {
    "p7_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS digest, length(coalesce(text, ''))::INTEGER AS n_chars FROM documents",
    "p8_valid": "SELECT DISTINCT pack_id, 0::BIGINT AS n_overfull, 0::BIGINT AS n_lost, 0::BIGINT AS n_split FROM pack_sizes WHERE capacity_tokens >= 1",
    "p9_limits": f"""WITH l AS (SELECT source, unnest(['chars', 'bytes']) AS unit, unnest([length(text), octet_length(encode(text))]) AS len FROM documents WHERE regexp_matches(text, '[^\\s\\x{{A0}}\\x{{200B}}\\x{{FEFF}}]')),
h AS (SELECT source, unit, len, len // {_BIN} AS bin, count(*) AS n FROM l GROUP BY ALL),
b AS (SELECT source, unit, bin, sum(n) AS m FROM h GROUP BY ALL),
x AS (SELECT h.*, b.m AS own, greatest(coalesce(p.m, 0), coalesce(q.m, 0)) AS beside, max(h.len) OVER (PARTITION BY h.source, h.unit) AS longest FROM h
  JOIN b ON h.source IS NOT DISTINCT FROM b.source AND h.unit = b.unit AND h.bin = b.bin
  LEFT JOIN b p ON h.source IS NOT DISTINCT FROM p.source AND h.unit = p.unit AND p.bin = h.bin - 1 LEFT JOIN b q ON h.source IS NOT DISTINCT FROM q.source AND h.unit = q.unit AND q.bin = h.bin + 1),
e AS (SELECT *, greatest(beside / {_BIN}.0::DOUBLE, (own - n) / {_BIN - 1}.0::DOUBLE) AS expected FROM x)
SELECT 'text' AS "column", source, unit, len::INTEGER AS "limit", n, expected, len = longest AS at_max FROM e WHERE n >= 5 AND n > expected + 6 * sqrt(expected) + 3""",
}

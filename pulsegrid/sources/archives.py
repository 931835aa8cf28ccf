"""Archives of one poll: tar.gz files with ``meta.json``, ``raw/<endpoint>.json`` and ``probe/<endpoint>.json``."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparse import iso_ts, parse_compact
from ..session import prepare

# Fixed value: <prefix>_<UTC>_<kind>_ok<k>of<n>[-x<endpoint> ...].tar.gz
CHUNK = r"^[a-z]+_(\d{8}T\d{6}Z)_([a-z]+)_ok(\d+)of(\d+)((?:-x[A-Za-z0-9]+)*)\.tar\.gz$"
MEMBERS = "chunk string, member string, body binary, error string"


def chunk_info(name: Column) -> Column:
    """(started_utc, kind, n_ok, n, failed) from a chunk's name; null if it isn't one."""
    part = lambda i: F.regexp_extract(name, CHUNK, i)
    return F.when(
        name.rlike(CHUNK),
        F.struct(
            parse_compact(part(1)).alias("started_utc"), part(2).alias("kind"), part(3).try_cast("int").alias("n_ok"), part(4).try_cast("int").alias("n"),
            F.filter(F.split(part(5), "-x"), lambda x: x != "").alias("failed"),
        ),
    )


def chunk_name(started_utc: Column, kind: Column, n_ok: Column, n: Column, failed: Column, prefix: str = "poll") -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.date_format(started_utc, "yyyyMMdd'T'HHmmss'Z'"), F.lit("_"), kind, F.lit("_ok"), n_ok.cast("string"), F.lit("of"), n.cast("string"), F.array_join(F.transform(failed, lambda x: F.concat(F.lit("-x"), x)), ""), F.lit(".tar.gz"))


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the chunks under ``folder`` with what their names tell; contents aren't read."""
    files = prepare(spark).read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar.gz").load(folder).select("path")
    return with_info(files.withColumn("chunk", F.element_at(F.split("path", "/"), -1)))


def with_info(chunks: DataFrame) -> DataFrame:
    return chunks.withColumn("_i", chunk_info(F.col("chunk"))).filter("_i is not null").select("*", "_i.*").drop("_i")


def start_of_day() -> Column:
    return F.date_trunc("DAY", F.current_timestamp())


def release_day(tag: Column, prefix: str = "raw-") -> Column:
    """The day of a release's tag such as raw-2026-09-29; null if it isn't one."""
    rest = F.substring(tag, len(prefix) + 1, 20)
    return F.when(tag.startswith(prefix) & rest.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), rest.try_cast("date"))


def between_days(rows: DataFrame, day: Column, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Rows whose ``day`` is from ``since`` on and before ``until``; rows without day are left out."""
    kept = rows.filter(day.isNotNull())
    kept = kept if since is None else kept.filter(day >= since)
    return kept if until is None else kept.filter(day < until)


def of_month(chunks: DataFrame, month: str) -> DataFrame:
    """Chunks of a calendar month (UTC) such as '2026-09'."""
    first = F.lit(f"{month}-01").cast("date")
    return between_days(chunks, F.to_date("started_utc"), first, F.add_months(first, 1))


def pending(chunks: DataFrame, ledger: DataFrame | None, cutoff: Column | None = None, lookback_days: int | None = None) -> DataFrame:
    """Chunks that started before ``cutoff`` (default: today, UTC) and aren't in the ledger.

    With ``lookback_days``, those of the cutoff's day and that many days before it only.
    """
    cutoff = start_of_day() if cutoff is None else cutoff
    early = chunks.filter(F.col("started_utc") < cutoff)
    if lookback_days is not None:
        early = between_days(early, F.to_date("started_utc"), F.date_sub(F.to_date(cutoff), lookback_days))
    return early if ledger is None else early.join(ledger.select("chunk").distinct(), "chunk", "left_anti")


def _untar(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for path, content in zip(frame.path, frame.content, strict=True):
            chunk = path.rsplit("/", 1)[-1]
            try:
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as tar:
                    for m in tar.getmembers():
                        if m.isfile():
                            rows.append((chunk, m.name, tar.extractfile(m).read(), None))
            except (tarfile.TarError, OSError, EOFError, gzip.BadGzipFile) as e:
                rows = [r for r in rows if r[0] != chunk]
                rows.append((chunk, None, None, f"{type(e).__name__}: {e}"[:500]))
        yield pd.DataFrame(rows, columns=["chunk", "member", "body", "error"])


def read_members(files: DataFrame) -> DataFrame:
    """(chunk, member, body, error) of a binaryFile frame, bodies as bytes; an unreadable archive gives one row with its error."""
    return files.select("path", "content").mapInPandas(_untar, MEMBERS)


def load_members(spark: SparkSession, folder: str) -> DataFrame:
    return read_members(prepare(spark).read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar.gz").load(folder))


def fetch_results(members: DataFrame, section: str = "endpoints") -> DataFrame:
    """One row per chunk and endpoint from ``meta.json``: status, ok, attempts, bytes, elapsed_s, fetched_at_utc, error."""
    prepare(members.sparkSession)
    meta = members.filter("member = 'meta.json'").withColumn("v", F.expr("try_parse_json(CASE WHEN is_valid_utf8(CAST(body AS string)) THEN CAST(body AS string) END)"))
    each = meta.select("chunk", F.explode(F.expr(f"coalesce(try_cast(try_variant_get(v, '$.{section}', 'variant') AS map<string, variant>), map())")).alias("endpoint", "r"))
    get = lambda k, t: F.expr(f"try_variant_get(r, '$.{k}', '{t}')").alias(k)
    return each.select("chunk", "endpoint", get("status", "double"), F.coalesce(get("ok", "boolean"), F.lit(False)).alias("ok"), get("attempts", "double"), get("bytes", "double"), get("elapsed_s", "double"), get("fetched_at_utc", "string"), get("error", "string"))


def probe_results(members: DataFrame) -> DataFrame:
    return fetch_results(members, "probes").select("chunk", "endpoint", F.col("status").cast("int").cast("string").alias("status"), "fetched_at_utc")


def bodies(members: DataFrame) -> DataFrame:
    """(chunk, endpoint, fetched_at_utc, body) of the raw members; without fetch time in the meta the chunk's start counts."""
    raw = members.filter(F.col("member").rlike(r"^raw/[^/]+\.json$")).select("chunk", F.regexp_extract("member", r"^raw/([^/]+)\.json$", 1).alias("endpoint"), "body")
    times = fetch_results(members).select("chunk", "endpoint", iso_ts(F.col("fetched_at_utc")).alias("at"))
    return raw.join(times, ["chunk", "endpoint"], "left").select("chunk", "endpoint", F.coalesce("at", chunk_info(F.col("chunk"))["started_utc"], F.current_timestamp()).alias("fetched_at_utc"), "body")


def unreadable(members: DataFrame) -> DataFrame:
    """Drift events of archives that can't be read."""
    return members.filter("error is not null").select(F.lit("*").alias("endpoint"), F.col("chunk").alias("path"), F.lit("chunk_unreadable").alias("kind"), F.col("error").alias("detail"), F.lit("ERROR").alias("severity"), "chunk")

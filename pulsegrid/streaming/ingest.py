"""From archives to the store, in batch and as a stream.

A store holds ``snapshots`` and ``trend``, and by month of their chunk the logs ``drift_events``, ``fetch_log``, ``probes``
and, written last, ``ledger``. Every write is an idempotent merge: a run that broke off is simply run again, and only
chunks that all else is stored of are in the ledger. The stream sends each micro-batch through the same writes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.drift import drift_events, drift_rollup, new_kinds
from ..operators.explode import snapshot_rows
from ..operators.merge import merge_log, merge_snapshots, merge_trend, read_log
from ..operators.monitor import live_probes
from ..operators.trend import trend_rows
from ..schema import BENIGN_DRIFT, DRIFT_EVENTS, FETCH_LOG, LEDGER, PROBES
from ..session import cut, prepare
from ..sources.archives import bodies, discover, fetch_results, pending, probe_results, read_members, start_of_day, unreadable


@dataclass
class Ingested:
    """What a batch did: partitions that changed, chunks taken and left for later, drift never seen before, live probes."""

    snapshots: list[tuple] = field(default_factory=list)
    trend: list[tuple] = field(default_factory=list)
    n_chunks: int = 0
    n_recent: int = 0
    new_drift: DataFrame | None = None
    live: DataFrame | None = None
    fetches: DataFrame | None = None
    ledger: DataFrame | None = None


def drift_log(spark: SparkSession, store: str) -> DataFrame:
    """The drift log of a store: its events rolled up. Events are stored once per chunk, so counts never double."""
    return drift_rollup(read_log(spark, f"{store}/drift_events", DRIFT_EVENTS).withColumnRenamed("example", "detail"))


def ingest_files(files: DataFrame, store: str) -> Ingested:
    """Merge a binaryFile frame of archives into ``store``; unreadable ones become drift and are in the ledger with 0 rows."""
    spark = files.sparkSession
    members = cut(read_members(files))
    raw = bodies(members)
    snaps, trends = cut(snapshot_rows(raw).withColumn("_chunk", F.col("chunk"))), cut(trend_rows(raw, with_chunk=True))
    events = cut(drift_events(raw).unionByName(unreadable(members)))
    done = Ingested(merge_snapshots(snaps, f"{store}/snapshots"), merge_trend(trends, f"{store}/trend"))
    seen = cut(drift_log(spark, store))
    done.new_drift = cut(new_kinds(seen, drift_rollup(events), BENIGN_DRIFT))
    # a chunk's events of one pattern are one row; the first detail is the example
    per_chunk = drift_rollup(events, per_chunk=True).select(*DRIFT_EVENTS.names)
    merge_log(per_chunk, f"{store}/drift_events", DRIFT_EVENTS, ("endpoint", "path", "kind", "pattern", "chunk"))
    done.fetches, probes = fetch_results(members), probe_results(members)
    merge_log(done.fetches, f"{store}/fetch_log", FETCH_LOG, ("chunk", "endpoint"))
    merge_log(probes, f"{store}/probes", PROBES, ("chunk", "endpoint"))
    done.live = live_probes(probes)
    per = lambda df, name: df.groupBy("chunk").agg(F.count("*").alias(name))
    counted = members.select("chunk").distinct()
    for part in (per(snaps, "snapshot_rows"), per(trends, "trend_rows"), per(events, "drift_events")):
        counted = counted.join(part, "chunk", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("string").alias(c) for c in ("snapshot_rows", "trend_rows", "drift_events")]
    done.ledger = cut(counted.select("chunk", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("ingested_at_utc"), *counts))
    done.n_chunks = done.ledger.count()
    merge_log(done.ledger, f"{store}/ledger", LEDGER, ("chunk",))
    return done


def consolidate(spark: SparkSession, folder: str, store: str, *, cutoff: Column | None = None, lookback_days: int | None = None, use_ledger: bool = True) -> Ingested:
    """Ingest the archives under ``folder`` that started before ``cutoff`` (default: today, UTC) and aren't in the ledger.

    ``lookback_days`` leaves out older ones. Only names are listed before the choice; contents of the chosen are read.
    """
    cutoff = start_of_day() if cutoff is None else cutoff
    found = discover(spark, folder)
    ledger = read_log(spark, f"{store}/ledger", LEDGER) if use_ledger else None
    n_recent = (found if ledger is None else found.join(ledger.select("chunk"), "chunk", "left_anti")).filter(F.col("started_utc") >= cutoff).count()
    paths = [r.path for r in pending(found, ledger, cutoff, lookback_days).select("path").collect()]  # names of new archives
    done = ingest_files(spark.read.format("binaryFile").load(paths), store) if paths else Ingested(ledger=ledger)
    done.n_recent = n_recent
    return done


def stream_archives(spark: SparkSession, folder: str, store: str, checkpoint: str, *, max_age: str = "14d", max_files: int = 500) -> StreamingQuery:
    """Ingest all archives that are new since the last run, then stop. Late ones count up to ``max_age``."""
    source = (
        prepare(spark).readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar.gz").option("maxFileAge", max_age).option("maxFilesPerTrigger", max_files).load(folder)
    )

    def write(batch: DataFrame, _: int) -> None:
        ingest_files(batch, store)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def observed_versions(trend_stream: DataFrame, lateness: str = "25 hours") -> DataFrame:
    """Versions of samples as a stream in update mode: least and greatest sighting per (entity, instant, value)."""
    return trend_stream.withWatermark("timestamp_utc", lateness).groupBy("entity", "timestamp_utc", "value").agg(F.min("first_seen_update_utc").alias("first_seen_update_utc"), F.max("last_seen_update_utc").alias("last_seen_update_utc"))


def hourly_stream(samples: DataFrame, instant: str, value: str, lateness: str = "25 hours") -> DataFrame:
    """Tumbling hours of a stream: mean and count; late rows count within ``lateness``."""
    return samples.withWatermark(instant, lateness).groupBy(F.window(instant, "1 hour").alias("w")).agg(F.avg(value).alias("value"), F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "value", "n")

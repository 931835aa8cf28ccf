"""Freshness and failure rules over chunk names. Input: (chunk, started_utc, kind, n_ok, n, failed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import minutes
from ..schema import ENDPOINTS

# The rules' thresholds.
STALE_MIN, TREND_STALE_MIN, WINDOW_H, EXPECTED_IN_WINDOW, LEAST_SHARE, MOST_FAILED = 90, 360, 12, 144, 0.5, 0.2


def failure_rates(chunks: DataFrame, now: Column, endpoints: tuple[str, ...] = ENDPOINTS) -> DataFrame:
    """(endpoint, n, rate): share of the last 12 hours' polls in which an endpoint failed."""
    recent = chunks.filter((F.col("kind") == "snap") & (F.col("started_utc") >= now - F.make_dt_interval(hours=F.lit(WINDOW_H))))
    each = recent.select("failed", F.explode(F.array(*map(F.lit, endpoints))).alias("endpoint"))
    return each.groupBy("endpoint").agg(F.count("*").alias("n"), F.avg(F.array_contains("failed", F.col("endpoint")).cast("double")).alias("rate"))


def alerts(chunks: DataFrame, now: Column, endpoints: tuple[str, ...] = ENDPOINTS) -> DataFrame:
    """(alert, detail) of every rule that fires; an empty table fires the three that miss polls."""
    age = lambda t: (F.unix_micros(now) - F.unix_micros(t)) / 60_000_000
    recent = (F.col("kind") == "snap") & (F.col("started_utc") >= now - F.make_dt_interval(hours=F.lit(WINDOW_H)))
    facts = chunks.agg(
        F.max(F.when(F.col("n_ok") > 0, F.col("started_utc"))).alias("last_any"),
        F.max(F.when((F.col("n_ok") > 0) & ~F.array_contains("failed", "sin"), F.col("started_utc"))).alias("last_trend"),
        F.count_if(recent).alias("n_recent"),
    )
    rule = lambda name, cond, detail: facts.filter(cond).select(F.lit(name).alias("alert"), detail.cast("string").alias("detail"))
    old = lambda c, limit: F.coalesce(age(F.col(c)) > limit, F.lit(True))
    failing = failure_rates(chunks, now, endpoints).filter(F.col("rate") > MOST_FAILED).select(F.concat(F.lit("endpoint-failing-"), "endpoint").alias("alert"), F.col("rate").cast("string").alias("detail"))
    return reduce(DataFrame.unionByName, (
        rule("snapshot-stale", old("last_any", STALE_MIN), F.col("last_any")),
        rule("sin-stale", old("last_trend", TREND_STALE_MIN), F.col("last_trend")),
        rule("snapshot-cadence", F.col("n_recent") < LEAST_SHARE * EXPECTED_IN_WINDOW, F.col("n_recent")),
        failing,
    ))


def recovered(chunks: DataFrame, now: Column) -> DataFrame:
    """Alerts that a full success within 90 minutes resolves."""
    full = chunks.filter((F.col("kind") == "snap") & (F.col("n_ok") == F.col("n")) & (F.col("n") > 0) & (F.col("started_utc") >= now - minutes(STALE_MIN)))
    return full.agg(F.count("*").alias("k")).filter("k > 0").select(F.explode(F.array(F.lit("fetch-failing"), F.lit("blocked"))).alias("alert"))


def capture_alerts(fetches: DataFrame) -> DataFrame:
    """(chunk, alert) from fetch results (chunk, kind, endpoint, status, ok, error): refused, nothing fetched, no trend.

    ``blocked``: an endpoint answered 401 or 403, or 503 from a challenge page. ``fetch-failing``: no endpoint of a
    snapshot poll succeeded. ``trend-capture-failing``: a trend poll without ``sin``.
    """
    refused = F.col("status").isin(401, 403) | ((F.col("status") == 503) & F.lower(F.coalesce("error", F.lit(""))).contains("cloudflare"))
    ok = F.coalesce(F.col("ok"), F.lit(False))
    facts = fetches.groupBy("chunk", "kind").agg(F.coalesce(F.bool_or(refused), F.lit(False)).alias("refused"), F.bool_or(ok).alias("any_ok"), F.coalesce(F.bool_or(ok & (F.col("endpoint") == "sin")), F.lit(False)).alias("sin_ok"))
    snap = F.col("kind") == "snap"
    fired = F.array(
        F.when(snap & F.col("refused"), F.lit("blocked")), F.when(snap & ~F.col("any_ok"), F.lit("fetch-failing")), F.when((F.col("kind") == "trend") & ~F.col("sin_ok"), F.lit("trend-capture-failing"))
    )
    return facts.select("chunk", F.explode(F.array_compact(fired)).alias("alert"))


def alert_actions(firing: DataFrame, open_alerts: DataFrame, resolved: DataFrame, now: Column, repeat_h: int = 12) -> DataFrame:
    """(alert, action): what firing and resolved alerts do to the open ones (alert, updated_utc).

    ``open`` one that isn't open yet, ``repeat`` one last touched more than ``repeat_h`` hours ago, ``none`` otherwise;
    ``close`` an open one that is resolved and doesn't fire.
    """
    fired, solved = firing.select("alert").distinct(), resolved.select("alert").distinct()
    held = open_alerts.groupBy("alert").agg(F.max("updated_utc").alias("updated_utc"))
    due = F.col("updated_utc") < now - F.make_dt_interval(hours=F.lit(repeat_h))
    action = F.when(F.col("is_open").isNull(), "open").when(due, "repeat").otherwise("none")
    acts = fired.join(held.withColumn("is_open", F.lit(True)), "alert", "left").select("alert", action.alias("action"))
    return acts.unionByName(held.join(solved, "alert", "left_semi").join(fired, "alert", "left_anti").select("alert", F.lit("close").alias("action")))


def latest_chunk(chunks: DataFrame, kind: str = "snap") -> DataFrame:
    """One row with the last start of a kind of poll, null if there is none."""
    return chunks.filter(F.col("kind") == kind).agg(F.max("started_utc").alias("last_started_utc"))


def live_probes(probes: DataFrame) -> DataFrame:
    """Probes of dead endpoints that answered."""
    return probes.filter("status = '200'")

"""Operational queries: source health, ingest rates, corroboration, run counters, heartbeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import DETAIL_CHARS, ERROR_CHARS

OUTCOMES = ("inserted", "deduped", "skipped", "filtered")


def active_sources(sources: DataFrame, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Active sources, of the kinds (in any case) if given, highest priority first."""
    df = sources.where("is_active")
    return (df.where(F.lower("source_type").isin(*kinds)) if kinds else df).orderBy(F.desc("priority"), "id")


def run_counters(outcomes: DataFrame) -> DataFrame:
    """(source_id, fetched, inserted, deduped, skipped, filtered) per source of (source_id, outcome)."""
    return outcomes.groupBy("source_id").agg(F.count("*").alias("fetched"), *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])


def message_outcomes(bridge: DataFrame) -> DataFrame:
    """(source_id, outcome) of each row of a bridge (report_id, source_id, external_id, published_at, id), by time: the first message
    of a report opened it, later ones joined it, a message told again was skipped. Rows without a time come first."""
    first = F.row_number().over(W.partitionBy("report_id", "source_id", "external_id").orderBy(F.col("published_at").asc_nulls_first(), "id")) == 1
    opened = bridge.groupBy("report_id").agg(F.min_by("id", F.struct(F.coalesce("published_at", F.timestamp_seconds(F.lit(0))), F.col("id"))).alias("_first"))
    rows = bridge.withColumn("_fresh", first).join(opened, "report_id")
    return rows.select("source_id", F.when(~F.col("_fresh"), "skipped").when(F.col("id") == F.col("_first"), "inserted").otherwise("deduped").alias("outcome"))


def totals(counters: DataFrame) -> DataFrame:
    return counters.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("fetched", *OUTCOMES)])


def ingest_rate(log: DataFrame, sources: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """(name, runs, fetched, inserted) of each source in the last hours, most inserted first. Rows stored twice count once."""
    recent = log.where(F.col("run_at") > as_of - F.expr(f"INTERVAL {hours} HOURS")).dropDuplicates(["id"])
    by = recent.groupBy("source_id").agg(F.count("*").alias("runs"), F.sum("fetched").alias("fetched"), F.sum("inserted").alias("inserted"))
    return by.join(sources.select(F.col("id").alias("source_id"), "name"), "source_id").select("name", "runs", "fetched", "inserted").orderBy(F.desc("inserted"), "name")


def unhealthy(sources: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    """(name, last_error, last_success_at) of active sources with an error or without a success in the last hours."""
    late = F.col("last_success_at") < as_of - F.expr(f"INTERVAL {hours} HOURS")
    return sources.where(F.col("is_active") & (F.col("last_error").isNotNull() | F.coalesce(late, F.lit(False)))).select("name", "last_error", "last_success_at")


def most_corroborated(reports: DataFrame, as_of: Column, hours: int = 24, most: int = 20) -> DataFrame:
    """(id, title, source_count) of the recent reports with the most sources: a top-k report. Ties by id."""
    recent = reports.where(F.col("published_at") > as_of - F.expr(f"INTERVAL {hours} HOURS")).dropDuplicates(["id"])
    return recent.select("id", "title", "source_count").orderBy(F.desc("source_count"), "id").limit(most)


def health(log: DataFrame) -> DataFrame:
    """(source_id, last_fetched_at, last_success_at, last_error, failures): state of each source after its runs.
    last_error is that of the last run, null after a success; failures are those since the last success."""
    runs = log.dropDuplicates(["id"])
    ok = F.max(F.when(F.col("ok"), F.col("run_at"))).alias("last_success_at")
    last = F.max(F.struct("run_at", "id", "ok", F.substring("error", 1, ERROR_CHARS).alias("error"))).alias("last")
    by = runs.groupBy("source_id").agg(ok, last)
    failed = runs.where("NOT ok").select(F.col("source_id").alias("_s"), "run_at").join(by.select("source_id", "last_success_at"), F.col("_s").eqNullSafe(F.col("source_id")))
    since = failed.where(F.col("last_success_at").isNull() | (F.col("run_at") > F.col("last_success_at"))).groupBy("_s").agg(F.count("*").alias("failures"))
    out = by.join(since, F.col("source_id").eqNullSafe(F.col("_s")), "left")
    return out.select("source_id", F.col("last.run_at").alias("last_fetched_at"), "last_success_at", F.when(~F.col("last.ok"), F.col("last.error")).alias("last_error"), F.coalesce("failures", F.lit(0)).alias("failures"))


def heartbeat(updates: DataFrame) -> DataFrame:
    """(key, connected, updated_at, detail): the last update of each key; ties go to the greater detail."""
    last = F.max(F.struct("updated_at", F.substring(F.coalesce("detail", F.lit("")), 1, DETAIL_CHARS).alias("detail"), "connected"))
    return updates.where("key IS NOT NULL").groupBy("key").agg(last.alias("m")).select("key", "m.connected", "m.updated_at", "m.detail")


def newest_per_key(df: DataFrame, key: str, order: list[Column], most: int) -> DataFrame:
    """The first rows of each key; Spark cuts at `most` before the shuffle, so no key gathers all its rows."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def filled_sources(reports: DataFrame, sources: DataFrame) -> DataFrame:
    """reports with source_id from the name where it is null, and published_at from created_at. Of several sources of a name, the least id."""
    named = sources.where("name IS NOT NULL").groupBy(F.col("name").alias("source_name")).agg(F.min("id").alias("_id"))
    return reports.join(named, "source_name", "left").withColumn("source_id", F.coalesce("source_id", "_id")).withColumn("published_at", F.coalesce("published_at", "created_at")).drop("_id")

"""Problem 1: the best value of each field among the reports of one event.

One aggregation by dedup_key takes, for each field, the maximum of a composite struct (usable, source's trust, time of
publication, value, id); occurred_at has no other rank than its value.
Maxima combine before the shuffle, so a key that holds a third of all rows sends one row per task and no more.

Ties: of equally trusted sources the later published report wins (no time counts as the earliest), then the larger value,
then the larger id. A group without a usable value has null there.
Rows without dedup_key form no group; a group needs two distinct ids. Rows stored twice change no maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blank_trim

# The severities, and the first year in which an event can have happened.
SEVERITIES = ("low", "medium", "high", "critical")
FIRST_YEAR = 2001


def ranked(reports: DataFrame, sources: DataFrame) -> DataFrame:
    """Reports with their source's trust and their usable values; `sources` is joined by id, or by name if source_id is null."""
    own = sources.groupBy("id").agg(F.max("trust_score").alias("t_id")).withColumnRenamed("id", "s_id")
    names = sources.where(F.col("name").isNotNull()).groupBy("name").agg(F.max("trust_score").alias("t_name")).withColumnRenamed("name", "s_name")
    df = reports.withColumn("_name", blank_trim("source_name"))
    df = df.join(own, df.source_id == own.s_id, "left").join(names, df._name == names.s_name, "left")
    severity = F.lower(blank_trim("severity"))
    at = F.col("occurred_at")
    fine = at.isNotNull() & (F.year(at) >= FIRST_YEAR) & (F.col("ingested_at").isNull() | (at <= F.col("ingested_at")))
    return df.select(
        *[c for c in reports.columns if c not in ("source_name", "severity", "occurred_at", "published_at")],
        F.coalesce("published_at", F.timestamp_seconds(F.lit(0))).alias("told_at"),
        F.coalesce(F.when(F.col("source_id").isNotNull(), F.col("t_id")).otherwise(F.col("t_name")), F.lit(-(2**31))).alias("trust"),
        F.col("s_name").alias("source_name"),
        F.when(severity.isin(*SEVERITIES), severity).alias("severity"),
        F.when(fine, at).alias("occurred_at"),
    )


def best(value: str, *rank: str) -> Column:
    """Aggregate: the largest (rank ..., value, id) of the rows that have the value; null if none has it."""
    parts = [F.col(c) for c in (*rank, value, "id")]
    return F.max(F.when(F.col(value).isNotNull(), F.struct(*[p.alias(f"_{i}") for i, p in enumerate(parts)])))


def survivors(reports: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per dedup_key of two or more ids: each field's surviving value and the id it comes from, and the group's least and greatest id."""
    df = ranked(reports.select("id", "dedup_key", "source_id", "source_name", "severity", "occurred_at", "ingested_at", "published_at").where("dedup_key IS NOT NULL AND id IS NOT NULL"), sources)
    made = df.groupBy("dedup_key").agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        best("source_name", "trust", "told_at").alias("n"),
        best("severity", "trust", "told_at").alias("s"),
        best("occurred_at").alias("o"),
    )
    return made.where("first_id <> last_id").select(
        "dedup_key",
        F.col("n._2").alias("source_name"), F.col("n._3").alias("source_name_id"),
        F.col("s._2").alias("severity"), F.col("s._3").alias("severity_id"),
        F.col("o._0").alias("occurred_at"), F.col("o._1").alias("occurred_at_id"),
    )


def surviving_ids(best_rows: DataFrame) -> DataFrame:
    """(dedup_key, field, id), long form of survivors()."""
    fields = ("source_name", "severity", "occurred_at")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_id").alias("id")) for f in fields])
    return best_rows.select("dedup_key", F.inline(each)).where("id IS NOT NULL")

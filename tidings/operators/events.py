"""Merging reports of one event: aggregates where an order doesn't matter, and one ordered fold where it does."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import strip
from .saving import FOLLOW_UP_CHARS, MEDIA, Event, tokens_of  # noqa: F401
from .severity import gravest

STALE_HOURS = 3


def is_follow_up(title: Column, content: Column) -> Column:
    """A short title or content with a marker of a follow-up or of a closed event."""
    hit = F.lit(False)
    for c in (title, content):
        t = strip(F.coalesce(c, F.lit("")))
        marked = F.lit(False)
        for m in dict.fromkeys(X.FOLLOW_UP + X.RESOLVED):
            marked = marked | t.contains(m)
        hit = hit | ((t != "") & (F.length(t) <= FOLLOW_UP_CHARS) & marked)
    return hit


def is_resolved(content: Column) -> Column:
    t = F.coalesce(content, F.lit(""))
    hit = F.lit(False)
    for m in X.RESOLVED:
        hit = hit | t.contains(m)
    return hit


def corroboration(bridge: DataFrame) -> DataFrame:
    """(report_id, sources, first_at, last_at) per report: distinct (source, message), first and last publication.
    Partial aggregates: a report with a third of all rows sends its distinct messages only. Null keys count as one value."""
    key = F.struct(F.coalesce("source_id", F.lit("")), F.coalesce("external_id", F.lit("")))
    return bridge.where("report_id IS NOT NULL").groupBy("report_id").agg(F.count_distinct(key).alias("sources"), F.min("published_at").alias("first_at"), F.max("published_at").alias("last_at"))


def escalation(rows: DataFrame, key: str, severity: str) -> DataFrame:
    """(key, severity): the gravest severity of each key."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(gravest(F.col(severity)).alias("severity"))


def gallery(items: DataFrame, key: str, url: str, order: str, most: int = MEDIA) -> DataFrame:
    """(key, media): the first `most` distinct urls of each key, in order of their first appearance.

    An url is reduced to its first appearance before the shuffle by key, and ranks are cut at `most` within each task, so
    no key's rows gather in one place.
    """
    from pyspark.sql import Window as W

    first = items.where(F.col(url).isNotNull() & (F.col(url) != "") & F.col(key).isNotNull()).groupBy(key, F.col(url).alias("url")).agg(F.min(order).alias("at"))
    top = first.withColumn("n", F.row_number().over(W.partitionBy(key).orderBy("at", "url"))).where(F.col("n") <= most)
    return top.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "url"))), lambda x: x["url"]).alias("media"))


def sessions(rows: DataFrame, key: str, at: str, hours: int = STALE_HOURS) -> DataFrame:
    """(key, started, ended, items): the runs of each key's rows with at most `hours` between neighbours; null keys and times are left out.
    Sessions combine before the exchange, so a key with a third of the rows sends its sessions, not its rows."""
    gap = F.session_window(at, f"{hours} hours 1 microsecond")  # the gap itself is still within
    made = rows.where(F.col(key).isNotNull() & F.col(at).isNotNull()).groupBy(key, gap).agg(F.min(at).alias("started"), F.max(at).alias("ended"), F.count("*").alias("items"))
    return made.select(key, "started", "ended", "items")


def closed_if_stale(reports: DataFrame, as_of: Column, hours: int = STALE_HOURS) -> DataFrame:
    """reports with status dismissed and severity low where the last publication is older; a null status or time stays."""
    stale = F.coalesce((F.col("published_at") < as_of - F.expr(f"INTERVAL {hours} HOURS")) & (F.col("status") != "dismissed"), F.lit(False))
    df = reports.withColumn("closed", stale)
    return df.withColumn("severity", F.when(F.col("closed"), F.lit("low")).otherwise(F.col("severity"))).withColumn("status", F.when(F.col("closed"), F.lit("dismissed")).otherwise(F.col("status")))


# --- the ordered fold -------------------------------------------------------------------------------------------------

FOLD = ("id", "source_id", "source_name", "source_url", "external_id", "title", "content", "severity", "published_at", "media")
FOLD_SCHEMA = "report_id string, content string, severity string, status string, sources int, first_at timestamp, first_source string, first_source_id string, first_url string, first_external_id string, last_at timestamp, media array<string>"


def fold_row(report_id: str, e: Event) -> dict:
    at = lambda micros: None if micros is None else pd.Timestamp(micros, unit="us")
    return {
        "report_id": report_id, "content": e.content, "severity": e.severity, "status": e.status, "sources": e.sources, "first_at": at(e.occurred_at), "first_source": e.source_name,
        "first_source_id": e.source_id, "first_url": e.source_url, "first_external_id": e.external_id, "last_at": at(e.published_at), "media": e.media,
    }


def fold_items(pdf: pd.DataFrame) -> Iterator[dict]:
    """The items of a batch of rows, times as microseconds, in the rows' order."""
    pdf = pdf.assign(published_at=pdf.published_at.astype("datetime64[us]").astype("int64").astype(object).where(pdf.published_at.notna(), None))
    columns = [c for c in pdf.columns if c != "media"]
    for values, media in zip(zip(*(pdf[c].astype(object).where(pdf[c].notna(), None) for c in columns)), pdf["media"] if "media" in pdf else [None] * len(pdf)):
        yield dict(zip(columns, values)) | {"media": () if media is None else list(media)}


def folded(items: DataFrame) -> DataFrame:
    """Each report's event after its items in order of publication (then id).

    items: (report_id, FOLD ...); source_url and media may be missing. The fold depends on order, so a report's items stream
    through one task in sorted order; what is held is the event, never its items, and a new line is held only against lines
    that share a token with it. Rows without report_id are left out; items without a time come first.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, event = None, Event()
        for pdf in batches:
            out = []
            for item in fold_items(pdf):
                if item["report_id"] != key:
                    if key is not None:
                        out.append(fold_row(key, event))
                    key, event = item["report_id"], Event()
                event.add(item)
            if out:
                yield pd.DataFrame(out)
        if key is not None:
            yield pd.DataFrame([fold_row(key, event)])

    missing = {"source_url": "string", "media": "array<string>"}
    rows = items.where("report_id IS NOT NULL").select("report_id", *[F.col(c) if c in items.columns or c not in missing else F.lit(None).cast(missing[c]).alias(c) for c in FOLD])
    return rows.repartition("report_id").sortWithinPartitions("report_id", "published_at", "id").mapInPandas(run, FOLD_SCHEMA)

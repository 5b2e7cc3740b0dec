"""Messages of live channels and polls taken in as micro-batches: seen ones dropped, the rest screened, saved and remembered.

Each batch reads the sources and the rules anew, so that what was switched off or added meanwhile counts from the next batch
on. All state is in tables: a batch decides by the tables as they were before it and writes each of them under its number, so a
batch that is done again after a crash, wherever it broke off, leaves the same tables: no message is lost or told twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicon import RulePack
from ..functions.text import DETAIL_CHARS
from ..operators import operations, saving, screening
from ..operators.duplicates import latest_report, unseen
from ..operators.enrich import enriched
from ..sources.readers import ALERT_TYPE, has_text, media_urls, messages_of
from ..sources.shared import kept
from ..sources.sinks import Log, Table

REPORTS = saving.EVENT.replace("occurred_at bigint, published_at bigint, created_at bigint", "occurred_at timestamp, published_at timestamp, created_at timestamp") + ", written_at timestamp"
BRIDGE = "report_id string, source_id string, source_name string, source_url string, external_id string, published_at timestamp, excerpt string, written_at timestamp"
SEEN = "source_id string, external_id string, kept boolean, reason string, written_at timestamp"
STATUS = "key string, connected boolean, updated_at timestamp, detail string"
RUNS = "source_id string, run_at timestamp, " + ", ".join(f"{c} bigint" for c in ("fetched", *operations.OUTCOMES))
MESSAGE = "channel string, message_id bigint, text string, published_at timestamp, arrived_at timestamp, media array<struct<url:string,mime:string,size:bigint>>"


@dataclass
class Ingest:
    """For foreachBatch: `Ingest(...)(batch, number)`. Messages are of MESSAGE; sources and rules are asked for in every batch.

    Sources of `official` kinds are not screened. A message too short to be an item that carries media adds them to the report
    that its source told of last.
    """

    spark: SparkSession
    root: str
    sources: Callable[[], DataFrame]
    gazetteer: Callable[[], DataFrame]
    pack: RulePack
    rules: Callable[[], DataFrame] | None = None
    verdicts: Callable[[str], dict | None] | None = None
    judge: Callable[[str, list[str]], int | None] | None = None
    official: tuple[str, ...] = (ALERT_TYPE,)

    def __post_init__(self) -> None:
        at = lambda name, schema, keys, newest: Table(self.spark, f"{self.root}/{name}", schema, keys, newest)
        self.reports = at("reports", REPORTS, ["id"], "written_at")
        self.bridge = at("report_sources", BRIDGE, ["report_id", "source_id", "external_id"], "written_at")
        self.seen = at("seen", SEEN, ["source_id", "external_id"], "written_at")
        self.status = at("status", STATUS, ["key"], "updated_at")
        self.runs = Log(self.spark, f"{self.root}/runs", RUNS)

    def __call__(self, batch: DataFrame, number: int) -> None:
        reports, bridge, seen = (t.read(before=number) for t in (self.reports, self.bridge, self.seen))
        sources = self.sources()
        messages = messages_of(batch, sources).withColumn("arrived_at", F.coalesce("arrived_at", "published_at"))
        fresh = kept(unseen(messages, seen, bridge))
        now = F.lit(messages.agg(F.max("arrived_at")).first()[0]).cast("timestamp")
        texts = fresh.where(has_text(F.col("text")))
        screened = kept(self._screened(texts))
        passing = kept(screened.where("keep").withColumn("id", _new_id()).select("id", "source_id", "source_name", "source_url", "external_id", "title", "content", "severity", "status", F.col("location_name").alias("place"), "published_at", "arrived_at", media_urls(F.col("media")).alias("media")))
        made = kept(saving.saved(passing, reports, bridge, judge=self.judge))
        events = saving.changed_events(made).withColumn("written_at", now)
        told = saving.bridge_rows(made, passing).withColumn("written_at", now)
        self.reports.upsert(self._with_media(kept(events.select(*_columns(REPORTS))), reports, bridge, told, fresh.where(~has_text(F.col("text"))), now), number)
        self.bridge.upsert(told, number)
        marked = screened.select("source_id", "external_id", F.col("keep").alias("kept"), "reason").unionByName(
            fresh.where(~has_text(F.col("text"))).select("source_id", "external_id", F.lit(False).alias("kept"), F.lit("short").alias("reason"))
        )
        self.seen.upsert(marked.withColumn("written_at", now), number)
        self._report(messages, fresh, screened, made, passing, now, number)

    def _screened(self, texts: DataFrame) -> DataFrame:
        """Items as the cascade leaves them: official ones as they are."""
        pack = self.pack if self.rules is None else screening.rules_from(self.rules(), self.pack)
        items = enriched(texts.withColumn("_key", F.xxhash64("source_id", "external_id")), "_key", "text", self.gazetteer(), F.coalesce("default_severity", F.lit("low"))).withColumn("status", F.lit("verified"))
        return screening.screened(items, pack, place="location_name", verdicts=self.verdicts, official=self.official)

    def _with_media(self, events: DataFrame, reports: DataFrame, bridge: DataFrame, told: DataFrame, short: DataFrame, now: Column) -> DataFrame:
        """The batch's events, and older ones, with the media of messages that are nothing but media."""
        media = kept(short.select(F.concat_ws("/", "source_id", "external_id").alias("id"), "source_id", F.coalesce("published_at", "arrived_at").alias("ts"), F.explode(media_urls(F.col("media"))).alias("url")))
        every = reports.join(events.select("id"), "id", "left_anti").select(*_columns(REPORTS)).unionByName(events)
        both = bridge.unionByName(told).select("report_id", "source_id", "published_at")
        found = latest_report(media.select("id", "source_id", "ts").distinct(), both, every.select("id", "created_at"))
        more = media.join(found, "id").groupBy("report_id").agg(F.array_sort(F.collect_list(F.struct("ts", "id", "url"))).alias("more")).withColumnRenamed("report_id", "id")
        with_more = every.join(more, "id").withColumn("media", F.slice(F.array_distinct(F.concat(F.coalesce("media", F.array().cast("array<string>")), F.col("more.url"))), 1, saving.MEDIA)).withColumn("written_at", now).drop("more")
        with_more = kept(with_more.select(*_columns(REPORTS)))
        return events.join(with_more.select("id"), "id", "left_anti").select(*_columns(REPORTS)).unionByName(with_more)

    def _report(self, messages: DataFrame, fresh: DataFrame, screened: DataFrame, made: DataFrame, passing: DataFrame, now: Column, number: int) -> None:
        """Outcomes per source and the heartbeat."""
        saved = saving.outcomes(made).join(passing.select(F.col("id").alias("item"), "source_id"), "item").select("source_id", "outcome")
        blocked = screened.where("NOT keep").select("source_id", F.lit("filtered").alias("outcome"))
        short = fresh.where(~has_text(F.col("text"))).select("source_id", F.lit("skipped").alias("outcome"))
        again = messages.groupBy("source_id").count().join(fresh.groupBy("source_id").agg(F.count("*").alias("new")), "source_id", "left").withColumn("again", F.col("count") - F.coalesce("new", F.lit(0)))
        counted = operations.run_counters(saved.unionByName(blocked).unionByName(short)).join(again.select("source_id", "again"), "source_id", "full").na.fill(0)
        rows = counted.withColumn("fetched", F.col("fetched") + F.col("again")).withColumn("skipped", F.col("skipped") + F.col("again")).withColumn("run_at", now)
        rows = kept(rows.select(*_columns(RUNS)))
        self.runs.append(rows, number)
        beat = operations.totals(rows.drop("run_at")).select(F.lit("ingest").alias("key"), F.lit(True).alias("connected"), now.alias("updated_at"), F.substring(F.concat(F.lit("fetched "), F.col("fetched"), F.lit(", inserted "), F.col("inserted")), 1, DETAIL_CHARS).alias("detail"))
        self.status.upsert(beat.where("updated_at IS NOT NULL"), number)


def _new_id() -> Column:
    """The id of the event that a message may open: made of its key, so that a batch done again makes the same."""
    return F.substring(F.sha1(F.concat_ws("/", "source_id", "external_id")), 1, 20)


def _columns(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.split(", ")]


def start(ingest: Ingest, streams: list[DataFrame], checkpoint: str, **trigger):
    """The running query over the union of live and polled messages: what arrives twice counts once."""
    both = streams[0]
    for s in streams[1:]:
        both = both.unionByName(s)
    return both.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def backfill(ingest: Ingest, messages: DataFrame, number: int, most: int = 10) -> None:
    """The newest messages of each channel as one batch, without a judge."""
    newest = operations.newest_per_key(messages, "channel", [F.desc("message_id")], most)
    replace(ingest, verdicts=None, judge=None)(newest, number)

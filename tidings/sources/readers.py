"""Feeds, alert snapshots and channel messages, as items of one shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import channel_handle, clean, feed_summary, first_text, image_in_html, strip
from ..operators.operations import newest_per_key

FEED_ENTRIES, AREAS, AREA_TEXT, LEAST_TEXT, BYTES = 25, 12, 70, 12, 8 * 1024 * 1024
FEED_TYPES, ALERT_TYPE = ("rss", "web", "news"), "oref"
# Links and media are elements with attributes; a link of an RSS item is its text.
MEDIA = "array<struct<_url:string,_type:string,_medium:string>>"
ENTRY = (
    "title string, link array<struct<_VALUE:string,_href:string,_rel:string>>, guid string, id string, pubDate string, updated string, published string, description string, summary string, content string, "
    f"enclosure {MEDIA}, `media:content` {MEDIA}, `media:thumbnail` {MEDIA}, `media:group` struct<`media:content`:{MEDIA},`media:thumbnail`:{MEDIA}>"
)
ALERT = "id string, cat string, title string, desc string, data array<string>"


def feed_entries(spark: SparkSession, path: str, tag: str = "item") -> DataFrame:
    """Entries of landed RSS (tag item) or Atom (tag entry) files, with the file's name as feed and their place in it.

    A file is split in order, and rows are numbered in the order of the splits, so the numbers of a file's entries rise."""
    return spark.read.format("xml").option("rowTag", tag).schema(ENTRY).load(path).withColumn("feed", F.input_file_name()).withColumn("place", F.monotonically_increasing_id())


def feed_time(*candidates: Column, now: Column) -> Column:
    """The first candidate that is a time, RFC 822 or ISO, in UTC; else now."""
    formats = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "yyyy-MM-dd'T'HH:mm:ssXXX")
    bare = [F.regexp_replace(strip(c), "^[A-Za-z]{3},[ ]*", "") for c in candidates]
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for c in bare for f in formats], now)


def entry_link(link: Column) -> Column:
    """The address of an entry: the text of an RSS link, or the href of an Atom link that is the alternate or has no relation."""
    href = F.filter(link, lambda x: x["_href"].isNotNull() & F.coalesce(x["_rel"] == "alternate", F.lit(True)))
    return first_text(F.get(F.filter(link["_VALUE"], lambda v: v != ""), F.lit(0)), F.get(href["_href"], F.lit(0)))


def entry_image(df: DataFrame) -> Column:
    """The first of: media content, media thumbnail, an enclosure that is an image, a video or of no type, an image in the text."""
    every = lambda name: F.concat(F.coalesce(F.col(f"`media:{name}`"), F.array()), F.coalesce(F.col("`media:group`")[f"media:{name}"], F.array()))
    url = lambda c: F.get(F.filter(c["_url"], lambda u: u.isNotNull() & (u != "")), F.lit(0))
    enclosed = F.filter("enclosure", lambda e: F.coalesce(e["_type"], F.lit("")).rlike("^(image|video)/|^$"))
    return F.coalesce(url(every("content")), url(every("thumbnail")), url(enclosed), image_in_html(F.coalesce("summary", "description")))


def feed_items(entries: DataFrame, now: Column, most: int = FEED_ENTRIES) -> DataFrame:
    """Items of the first entries of each feed, in the feed's order; those without title and text are dropped. entries as of
    feed_entries(). external_id is the guid or id, else the link, else the title."""
    at = entries.withColumn("published_at", feed_time(F.col("pubDate"), F.col("published"), F.col("updated"), now=now)).withColumn("_link", entry_link(F.col("link")))
    df = newest_per_key(at, "feed", [F.col("place")], most)
    df = df.select(
        "feed", "published_at",
        clean(F.col("title")).alias("title"), feed_summary(F.col("summary"), F.col("description"), F.col("content")).alias("text"),
        first_text(F.col("guid"), F.col("id"), F.col("_link"), F.col("title")).alias("external_id"), F.col("_link").alias("source_url"),
        entry_image(df).alias("image_url"),
    )
    return df.where("title <> '' OR text <> ''").withColumn("content", F.coalesce(F.nullif("text", F.lit("")), F.col("title"))).drop("text")


def alerts(bodies: DataFrame, body: str) -> DataFrame:
    """(…, id, cat, title, desc, data) of each alert in snapshot bodies: an object, or a list whose objects count; anything
    else - empty, `{}`, no JSON, a scalar - holds none. Alerts without areas are left out."""
    t = strip(F.col(body))
    parts = F.when(t.rlike(r"^\{"), F.array(t)).when(t.rlike(r"^\["), F.from_json(t, "array<string>"))
    rows = bodies.withColumn("_a", F.explode(F.filter(F.coalesce(parts, F.array().cast("array<string>")), lambda x: x.rlike(r"^\s*\{"))))
    return rows.withColumn("_a", F.from_json("_a", ALERT)).where(F.size("_a.data") > 0).select(*bodies.columns, "_a.*")


def alert_items(rows: DataFrame) -> DataFrame:
    """(external_id, title, content, areas, area, cat): one item per alert, its areas without empty ones, twelve at most."""
    areas = F.slice(F.filter(F.transform("data", strip), lambda a: a != ""), 1, AREAS)
    joined = F.array_join("areas", ", ")
    df = rows.withColumn("areas", areas).where(F.size("areas") > 0).withColumn("title", clean(F.col("title")))
    named = F.when(F.size("areas") == 1, F.concat_ws(" - ", "title", F.element_at("areas", 1))).otherwise(F.concat_ws(" - ", F.col("title"), F.substring(joined, 1, AREA_TEXT)))
    whole = F.array_join(F.transform("data", strip), ",")
    return df.select(
        F.coalesce(F.nullif("id", F.lit("")), F.substring(F.sha1(F.concat_ws("|", "title", whole)), 1, 16)).alias("external_id"), named.alias("title"),
        F.concat_ws(". ", F.concat_ws(": ", "title", joined), F.nullif(F.col("desc"), F.lit(""))).alias("content"), "areas", F.element_at("areas", 1).alias("area"), "cat",
    )


def messages_of(messages: DataFrame, sources: DataFrame) -> DataFrame:
    """Messages (channel, message_id, text, published_at, ...) of active sources, with their source and its address."""
    own = sources.where("is_active").select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), "source_type", "default_severity", channel_handle(F.col("handle"), F.col("url")).alias("channel"))
    df = messages.join(own.where("channel IS NOT NULL"), "channel").withColumn("external_id", F.col("message_id").cast("string"))
    return df.withColumn("source_url", F.concat(F.lit("https://t.me/"), "channel", F.lit("/"), F.col("external_id")))


def has_text(text: Column) -> Column:
    """Long enough to be an item by itself."""
    return F.coalesce(F.length(strip(text)) >= LEAST_TEXT, F.lit(False))


def message_items(messages: DataFrame, sources: DataFrame) -> DataFrame:
    """messages_of() that are items. Shorter texts are none."""
    return messages_of(messages.where(has_text(F.col("text"))), sources)


def media_allowed(mime: Column, size: Column) -> Column:
    return F.coalesce(mime.rlike("^(image|video)/") & (size <= BYTES), F.lit(False))


def media_urls(media: Column) -> Column:
    """The addresses of allowed media, of an array of (url, mime, size)."""
    return F.filter(F.transform(F.filter(media, lambda m: media_allowed(m["mime"], m["size"])), lambda m: m["url"]), lambda u: u.isNotNull() & (u != ""))

import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidings.sources import readers, sinks
from tidings.streaming import events as streams

T = datetime(2026, 1, 1, 12)


def test_alert_snapshots(spark):
    bodies = [
        '{"id": "1", "cat": "1", "title": "ירי", "desc": "d", "data": ["א", " ", "ב"]}', '[{"id": "2", "title": "ירי", "data": ["ג"]}, 5, {"id": "3", "title": "x", "data": []}, {"id": "", "title": "y", "data": ["ד"]}]',
        "{}", "", "not json", "7", None, "[]", '{"id": "4", "title": "no data"}',
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = {r.external_id: r for r in readers.alert_items(readers.alerts(df, "body")).collect()}
    assert set(got) >= {"1", "2"} and len(got) == 3
    assert got["1"].areas == ["א", "ב"] and got["1"].area == "א" and got["2"].title == "ירי - ג"
    assert all(len(k) in (1, 16) for k in got)


def test_feeds(spark, tmp_path):
    (tmp_path / "f.xml").write_text(
        """<rss><channel>
<item><title>אזעקות בצפון</title><link>http://x/1</link><guid>g1</guid><pubDate>Thu, 01 Jan 2026 10:00:00 +0200</pubDate><description>&lt;p&gt;פרטים &lt;img src="http://i/1.jpg"&gt; כאן&lt;/p&gt;</description></item>
<item><title></title><description></description><guid>g2</guid></item>
<item><title>שני</title><link>http://x/3</link><pubDate>never</pubDate><enclosure url="http://v/3.mp4" type="video/mp4"/></item>
</channel></rss>""",
        encoding="utf-8",
    )
    got = {r.external_id: r for r in readers.feed_items(readers.feed_entries(spark, str(tmp_path)), F.lit(T)).collect()}
    assert set(got) == {"g1", "http://x/3"}
    assert (got["g1"].content, got["g1"].image_url, got["g1"].published_at) == ("פרטים כאן", "http://i/1.jpg", datetime(2026, 1, 1, 8))
    assert (got["http://x/3"].content, got["http://x/3"].image_url, got["http://x/3"].published_at) == ("שני", "http://v/3.mp4", T)


def test_messages(spark):
    sources = spark.createDataFrame([("s", "S", "@chan", None, "telegram", True, "low"), ("o", "O", "off", None, "telegram", False, "low")], "id string, name string, handle string, url string, source_type string, is_active boolean, default_severity string")
    messages = spark.createDataFrame([("chan", 5, "a text that is long enough", T), ("chan", 6, "  short \n", T), ("off", 7, "a text that is long enough", T)], "channel string, message_id long, text string, published_at timestamp")
    rows = readers.message_items(messages, sources).collect()
    assert [(r.external_id, r.source_url) for r in rows] == [("5", "https://t.me/chan/5")]


def test_feed_media_links_and_order(spark, tmp_path):
    items = "".join(f"<item><title>t{i}</title><link>http://x/{i}</link><pubDate>Thu, 01 Jan 2026 {10 + i % 12}:00:00 GMT</pubDate></item>" for i in range(30))
    (tmp_path / "rss").mkdir(), (tmp_path / "atom").mkdir()
    (tmp_path / "rss" / "a.xml").write_text(
        f"""<rss xmlns:media="m"><channel><item><title>m</title><guid>g</guid><media:content url="http://i/c.jpg" medium="image"/><media:thumbnail url="http://i/t.jpg"/></item>
<item><title>n</title><guid>h</guid><media:thumbnail url="http://i/t.jpg"/><enclosure url="http://a.mp3" type="audio/mpeg"/></item>
<item><title>o</title><guid>i</guid><enclosure url="http://a.mp3" type="audio/mpeg"/><enclosure url="http://a.bin"/></item>{items}</channel></rss>""",
        encoding="utf-8",
    )
    (tmp_path / "atom" / "b.xml").write_text('<feed><entry><title>e</title><id>u1</id><link rel="self" href="http://s"/><link rel="alternate" href="http://y/1"/><updated>2026-01-01T10:00:00Z</updated></entry><entry><title>f</title><link href="http://y/2"/></entry></feed>', encoding="utf-8")
    got = {r.external_id: r for r in readers.feed_items(readers.feed_entries(spark, str(tmp_path / "rss")), F.lit(T)).collect()}
    assert (got["g"].image_url, got["h"].image_url, got["i"].image_url) == ("http://i/c.jpg", "http://i/t.jpg", "http://a.bin")
    assert set(got) == {"g", "h", "i"} | {f"http://x/{i}" for i in range(22)}
    atom = {r.external_id: r for r in readers.feed_items(readers.feed_entries(spark, str(tmp_path / "atom"), "entry"), F.lit(T)).collect()}
    assert (atom["u1"].source_url, atom["u1"].published_at, atom["http://y/2"].published_at) == ("http://y/1", datetime(2026, 1, 1, 10), T)


def test_media_gate(spark):
    df = spark.createDataFrame([("image/png", 10), ("video/mp4", 9 * 1024 * 1024), ("text/html", 1), (None, 1)], "m string, s long")
    assert [r[0] for r in df.select(readers.media_allowed(F.col("m"), F.col("s"))).collect()] == [True, False, False, False]


def test_upserts_are_idempotent_and_rewrite_what_they_touch(spark, tmp_path):
    schema = "k string, v string, at timestamp"
    t = sinks.Table(spark, str(tmp_path / "t"), schema, ["k"], "at", partitions=8)
    assert t.read().count() == 0
    t.upsert(spark.createDataFrame([(f"k{i}", "1", T) for i in range(40)] + [(None, "n", T)], schema), 0)
    for _ in range(2):
        t.upsert(spark.createDataFrame([("k1", "2", T + timedelta(1)), ("k2", "0", T - timedelta(1)), ("c", "3", T)], schema), 1)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 42 and (got["k1"], got["k2"], got["c"], got["k3"], got[None]) == ("2", "1", "3", "1", "n") and t.batches() == [0, 1]
    assert {r.k: r.v for r in t.read(before=1).collect()}["k1"] == "1"
    assert 1 <= len(list((tmp_path / "t" / "data" / "1").glob("_part=*"))) <= 3
    for b in range(2, 9):
        t.upsert(spark.createDataFrame([("k1", str(b), T + timedelta(b))], schema), b)
    t.upsert(spark.createDataFrame([], schema), 9)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 42 and got["k1"] == "8" and t.batches() == [7, 8, 9]
    kept_folders = sorted(int(p.name) for p in (tmp_path / "t" / "data").iterdir())
    assert kept_folders[0] == 0 and 3 not in kept_folders and len(kept_folders) <= 5


def test_cascade(spark):
    children = spark.createDataFrame([("r1", 1), ("r2", 2), (None, 3)], "report_id string, n int")
    gone = spark.createDataFrame([("r1",), ("r1",)], "report_id string")
    assert sorted(r.n for r in sinks.without_children(children, gone, "report_id").collect()) == [2, 3]


def test_stream_merges_events(spark, tmp_path):
    columns = "report_id string, id string, source_id string, source_name string, external_id string, title string, content string, severity string, published_at timestamp"
    rows = [("r", f"i{i}", f"s{i % 2}", f"S{i % 2}", str(i % 3), None, f"תוכן ראשון מספר {i}", "high" if i == 2 else "low", T + timedelta(minutes=i)) for i in range(6)]
    for k in (0, 1):
        spark.createDataFrame(rows[k * 3 : k * 3 + 3], columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    items = (spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    q = streams.merged_events(items).writeStream.outputMode("update").format("memory").queryName("merged").option("checkpointLocation", str(tmp_path / "c")).start()
    last, until = None, time.time() + 90
    # With timers set the query goes on for as long as events are open, so it is stopped by the test.
    while (last is None or last.sources < 6) and time.time() < until:
        time.sleep(1)
        last = spark.sql("SELECT * FROM merged ORDER BY sources DESC").first()
    q.stop()
    assert (last.report_id, last.sources, last.severity, last.first_at) == ("r", 6, "high", T)


def test_silent_events_are_closed_and_forgotten(spark, tmp_path):
    columns = "report_id string, id string, source_id string, source_name string, external_id string, title string, content string, severity string, published_at timestamp"
    spark.createDataFrame([("r", "i", "s", "S", "1", None, "טקסט על אירוע", "high", T)], columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = streams.merged_events(spark.readStream.schema(columns).parquet(str(tmp_path / "in")), streams.EventMerger(1_000, 1_000)).writeStream.outputMode("update").format("memory").queryName("closing").option("checkpointLocation", str(tmp_path / "c")).start()
    until, rows = time.time() + 90, []
    while len(rows) < 2 and time.time() < until:
        time.sleep(1)
        rows = [(r.closed, r.status, r.severity) for r in spark.sql("SELECT * FROM closing").collect()]
    time.sleep(6)
    q.stop()
    assert rows == [(False, "verified", "high"), (True, "dismissed", "low")] and spark.table("closing").count() == 2


def test_stream_drops_repeats(spark, tmp_path):
    columns = "source_id string, external_id string, published_at timestamp"
    rows = [("s", "1", T), ("s", "1", T + timedelta(minutes=1)), ("s", "2", T), ("t", "1", T)]
    for part in (rows, rows[:2]):
        spark.createDataFrame(part, columns).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    items = streams.once(spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    q = items.writeStream.outputMode("append").format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert spark.table("once").count() == 3

"""Messages taken in by micro-batches: sources and rules read anew, nothing lost or doubled when a batch breaks off."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidings.functions.lexicon import RulePack
from tidings.operators import places
from tidings.streaming import ingest as streams

T = datetime(2026, 1, 1, 12)
SOURCE = "id string, name string, handle string, url string, source_type string, is_active boolean, default_severity string"
PACK = RulePack(impact=("אזעקות", "יירוט", "פיצוץ"), least_letters=5, resolution=("האירוע הסתיים",), blocks={"ads": ["מבצע"]})


def message(channel, n, text, minutes, media=None):
    at = T + timedelta(minutes=minutes)
    return (channel, n, text, at, at, media)


MESSAGES = [
    [message("a", 1, "אזעקות הופעלו בקריית שמונה הבוקר", 0), message("a", 2, "מבצע גדול על אזעקות לרכב", 1), message("b", 7, "אזעקות הופעלו בקריית שמונה הבוקר כעת", 2), message("off", 1, "אזעקות הופעלו בחיפה ליד הנמל", 2)],
    [message("a", 1, "אזעקות הופעלו בקריית שמונה הבוקר", 0), message("a", 3, None, 5, [("http://i/1.jpg", "image/jpeg", 10), ("http://i/big", "video/mp4", 10**9)]), message("o", 5, "התרעה רשמית בלי מילים ידועות", 6)],
    [message("b", 8, "האירוע הסתיים", 9), message("c", 1, "פיצוץ עז נשמע ליד הנמל בחיפה", 10), message("a", 4, "רחפן נראה ויירוט מעל הגבול", 11)],
]


@pytest.fixture
def made(spark, tmp_path):
    places_ = spark.createDataFrame([(1, "קריית שמונה", 1.0, 2.0), (2, "חיפה", 3.0, 4.0)], "place_id int, name string, latitude double, longitude double")
    terms = places.gazetteer(places_, spark.createDataFrame([], "alias string, place_id int"))
    state = {"sources": [("sa", "A", "@a", None, "telegram", True, "low"), ("sb", "B", "b", None, "telegram", True, None), ("so", "O", "o", None, "oref", True, "critical"), ("sx", "X", "off", None, "telegram", False, "low")], "rules": []}

    def build(root="state"):
        return streams.Ingest(
            spark, str(tmp_path / root), lambda: spark.createDataFrame(state["sources"], SOURCE), lambda: terms, PACK,
            rules=lambda: spark.createDataFrame(state["rules"], "name string, rule_type string, keywords string, is_active boolean"),
        )

    return build, state, tmp_path


def snapshot(i):
    reports = sorted((r.content, r.severity, r.status, r.sources, r.place, tuple(r.media or ())) for r in i.reports.read().collect())
    return reports, sorted((r.source_id, r.external_id, r.kept, r.reason) for r in i.seen.read().collect()), sorted((r.source_id, r.external_id, r.excerpt) for r in i.bridge.read().collect()), sorted(tuple(r) for r in i.runs.read().collect())


def run(spark, i, state, numbers, fail=None):
    for n in numbers:
        if n == 2:
            state["sources"] = [*state["sources"][:3], ("sc", "C", "c", None, "telegram", True, "high")]
            state["rules"] = [("drones", "suppress", "רחפן", True)]
        batch = spark.createDataFrame(MESSAGES[n], streams.MESSAGE)
        if fail == n:
            broken = i.seen.upsert
            i.seen.upsert = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
            with pytest.raises(RuntimeError):
                i(batch, n)
            i.seen.upsert = broken
        i(batch, n)


def test_batches(spark, made):
    build, state, _ = made
    i = build()
    run(spark, i, state, range(3))
    reports, seen, bridge, runs = snapshot(i)
    by = {r[0].split("\n")[0]: r for r in reports}
    assert len(reports) == 3
    first = by["אזעקות הופעלו בקריית שמונה הבוקר"]
    # The second channel's report joins, its closing follow-up closes, the picture without a text is added.
    assert (first[1], first[2], first[3], first[4], first[5]) == ("low", "dismissed", 3, "קריית שמונה", ("http://i/1.jpg",)) and "האירוע הסתיים" in first[0]
    assert by["התרעה רשמית בלי מילים ידועות"][1] == "critical" and by["פיצוץ עז נשמע ליד הנמל בחיפה"][1] == "high"
    marks = {(s, e): (k, r) for s, e, k, r in seen}
    assert marks["sa", "2"] == (False, "blocked: ads") and marks["sa", "3"] == (False, "short") and marks["so", "5"] == (True, "official") and marks["sa", "4"] == (False, "blocked: drones")
    assert ("sx", "1") not in marks and len(bridge) == 5
    counts = {}
    for r in runs:
        for k, v in zip(("fetched", *streams.operations.OUTCOMES), r[2:]):
            counts[k] = counts.get(k, 0) + v
    assert counts == {"fetched": 9, "inserted": 3, "deduped": 2, "skipped": 2, "filtered": 2}
    assert i.status.read().first().detail.startswith("fetched 3")


def test_a_batch_that_broke_off_is_done_again(spark, made):
    build, state, _ = made
    sources = list(state["sources"])
    whole = build("whole")
    run(spark, whole, state, range(3))
    state["sources"], state["rules"] = sources, []
    broken = build("broken")
    run(spark, broken, state, range(3), fail=1)
    assert snapshot(broken) == snapshot(whole)


def test_live_and_polled_streams(spark, made):
    build, state, tmp_path = made
    for name, parts in (("live", MESSAGES[:2]), ("poll", MESSAGES[1:2])):
        for part in parts:
            spark.createDataFrame(part, streams.MESSAGE).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    i = build()
    read = [spark.readStream.schema(streams.MESSAGE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name)) for name in ("live", "poll")]
    q = streams.start(i, read, str(tmp_path / "check"))
    assert q.awaitTermination(240) and q.exception() is None
    assert len(snapshot(i)[0]) == 2 and i.reports.batches()
    streams.backfill(i, spark.createDataFrame(MESSAGES[2], streams.MESSAGE), 99, most=1)
    assert {r.source_id for r in i.seen.read().collect()} >= {"sa", "sb", "so"}

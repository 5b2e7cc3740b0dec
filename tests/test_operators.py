from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidings.functions import text, tokens
from tidings.functions.lexicon import Reject, RulePack
from tidings.operators import duplicates, enrich, events, operations, places, saving, screening, severity

T = datetime(2026, 1, 1, 12)


@pytest.fixture(scope="module")
def gazetteer(spark):
    p = spark.createDataFrame([(1, "קריית שמונה", 1.0, 2.0), (2, "לבנון", 3.0, 4.0), (3, "דרום לבנון", 5.0, 6.0), (4, "העיר העתיקה", 7.0, 8.0), (5, "עזה", 9.0, 10.0), (6, "גדרה", 11.0, 12.0), (7, "מודיעין", 13.0, 14.0)], "place_id int, name string, latitude double, longitude double")
    a = spark.createDataFrame([("קרית שמונה", 1)], "alias string, place_id int")
    return p, a


def test_places(spark, gazetteer):
    texts = [
        "אזעקות בקריית שמונה", "בקרית שמונה", "ירי בדרום לבנון", "אירוע בעיר העתיקה", "דיווח מעזה", "ירי ליד עזה", "זו הגדרה חדשה",
        "מודיעין אסף", "אין כאן מקום", "", "לבנון וגם קריית שמונה",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").withColumn("m", text.matchable(text.clean(F.col("t"))))
    got = {r.id: r.name for r in places.located(df, "id", "m", places.gazetteer(*gazetteer), ambiguous=("מודיעין",), not_places={"גדרה": ("הגדרה",)}).collect()}
    assert got == {0: "קריית שמונה", 1: "קריית שמונה", 2: "דרום לבנון", 3: "העיר העתיקה", 5: "עזה", 10: "קריית שמונה"}


def test_resolved_names(spark, gazetteer):
    df = spark.createDataFrame([(1, " קרית שמונה "), (2, "עזה"), (3, "nowhere"), (4, None)], "id int, n string")
    got = {r.id: (r.place, r.latitude) for r in places.resolved(df, "n", *gazetteer).collect()}
    assert got == {1: ("קריית שמונה", 1.0), 2: ("עזה", 9.0), 3: ("nowhere", None), 4: (None, None)}


def test_severity(spark):
    rows = [("פיגוע בצומת", "critical"), ("אזעקות, התברר כשווא", "medium"), ("האירוע הסתיים", "low"), ("סתם טקסט", "high"), ("", "high"), (None, "high")]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    got = [r[0] for r in df.select(severity.severity(text.matchable(text.clean(F.col("t"))), default="high")).collect()]
    assert got == [s for _, s in rows]


PACK = RulePack(
    blocks={"ads": ["מבצע"], "crime": ["שוד"]}, ambiguous=("crime",), context=("מחבל",), no_context=("כלא",),
    rejects=(Reject("arrest", (("נעצר",),), ("ירי",)), Reject("abroad", (("פולין",),), ("ישראל",), no_place=True)),
    live=("כרגע",), past=("אתמול",), statement=("הודיע",), impact=("אזעקה", "כטבם"), weak=("כטבם",), outbound=("תקף",), promote=("דחוף",), review=("לבדיקה",),
    casualties=("נהרג",), meta=("הדמיה",),
)


def screen(spark, rows, **more):
    df = spark.createDataFrame([(i, t, "", "low", "verified", None) for i, t in enumerate(rows)], "id int, title string, content string, severity string, status string, place string")
    return {r.id: r for r in screening.screened(df, PACK, place="place", **more).collect()}


def test_cascade_gives_the_first_reason(spark):
    got = screen(spark, [
        "English text only in this one here", "אזעקה בצפון ومعها نص عربي", "מבצע גדול אזעקה כאן", "שוד בחנות במרכז העיר אתמול", "שוד של מחבל, אזעקה בעיר", "שוד של מחבל בתוך כלא ביום",
        "אדם אחד נעצר אחרי מרדף", "אדם אחד נעצר אחרי ירי, אזעקה", "אירוע גדול בפולין היום", "אזעקה הופעלה אתמול בצפון", "אזעקה הופעלה אתמול וגם כרגע", "כטבם התגלה וצהל תקף בתגובה",
        "כטבם התגלה בשמי הצפון", "סתם משהו דחוף קורה בעיר", "אזעקה לבדיקה בשמי הצפון", "",
    ])
    reasons = [got[i].reason for i in range(16)]
    assert reasons[:4] == ["language", "other script", "blocked: ads", "blocked: crime"]
    assert (got[4].keep, reasons[5], reasons[6], got[7].keep, reasons[8], reasons[9]) == (True, "blocked: crime", "arrest", True, "abroad", "past: אתמול")
    assert (got[10].keep, reasons[11], got[12].keep, got[13].keep, got[14].status, got[15].keep) == (True, "outbound", True, True, "reviewing", False)


def test_judged(spark):
    def judge(t):
        if "שקט" in t:
            return None
        return {"relevant": "טוב" in t, "reason": "", "category": "c", "severity": "critical", "summary": "מישהו נהרג כאן" if "בדוי" in t else "תקציר"}

    got = screen(spark, ["אזעקה טוב מאוד בצפון", "אזעקה רע מאוד בצפון", "אזעקה טוב בדוי בצפון", "אזעקה שקט מאוד בצפון"], verdicts=judge)
    assert [got[i].keep for i in range(4)] == [True, False, True, True]
    assert (got[0].content, got[0].severity, got[0].filter) == ("תקציר", "critical", "judge")
    assert (got[2].status, got[2].filter, got[3].filter) == ("reviewing", "fallback", "fallback")


def test_rules_of_a_table(spark):
    rules = spark.createDataFrame([("x", "suppress", "a, b ,", True), (None, "promote", "c", True), ("z", "review", "d", True), ("off", "suppress", "e", False), ("x", None, "f", True), ("empty", "promote", " , ", True)], "name string, rule_type string, keywords string, is_active boolean")
    made = screening.rules_from(rules, RulePack())
    assert made.blocks == {"x": ["a", "b", "f"]} and made.promote == ("c",) and made.review == ("d",)


def test_unseen_items(spark):
    items = spark.createDataFrame([("s", "1"), ("s", "1"), ("s", "2"), ("t", "1"), (None, "9"), (None, "9")], "source_id string, external_id string")
    seen = spark.createDataFrame([("s", "2"), (None, "9")], "source_id string, external_id string")
    assert sorted(map(tuple, duplicates.unseen(items, seen, seen).collect()), key=str) == sorted([("s", "1"), ("t", "1"), (None, "9"), (None, "9")], key=str)


def _events(spark):
    import random

    r = random.Random(4)
    words = [f"w{i}" for i in range(30)]
    rows = [(f"e{i:03}", T + timedelta(minutes=r.randint(0, 1500)), sorted({r.choice(words) for _ in range(r.randint(0, 9))}), r.choice(["p", "q", "", None]), ["w1", "w2"]) for i in range(120)]
    rows += [("x1", None, ["w1"], None, []), ("x2", T, None, None, [])]
    return rows, spark.createDataFrame(rows, "id string, ts timestamp, tokens array<string>, place string, place_tokens array<string>")


def test_similar_and_tight_pairs_match_brute_force(spark):
    rows, df = _events(spark)
    full = [r for r in rows if r[1] is not None and r[2]]
    similar, tight = set(), set()
    for a in full:
        for b in full:
            if (b[1], b[0]) < (a[1], a[0]):
                A, B = set(a[2]), set(b[2])
                if a[1] - b[1] <= timedelta(hours=6) and len(A & B) / len(A | B) >= 0.3:
                    similar.add((a[0], b[0]))
                if a[1] - b[1] <= timedelta(minutes=90) and (not a[3] or not b[3] or a[3] == b[3]):
                    if len((A & B) - set(a[4] if a[3] else b[4])) >= (1 if a[3] or b[3] else 2):
                        tight.add((a[0], b[0]))
    pairs = duplicates.similar_earlier(df)
    assert {(r.id, r.other) for r in pairs.collect()} == similar and similar
    assert {(r.id, r.other) for r in duplicates.tight_earlier(df).collect()} == tight and tight
    best = duplicates.best_earlier(df, pairs).collect()
    assert sum(r.links for r in best) == len(similar)


def test_asof_edges(spark):
    p = spark.createDataFrame([("a", "s", T), ("b", "s", T + timedelta(seconds=1)), ("c", "t", T), ("d", None, T)], "id string, source_id string, ts timestamp")
    e = spark.createDataFrame([("e1", "s", T - timedelta(minutes=15)), ("e2", "s", T + timedelta(minutes=1)), ("e3", None, T)], "event_id string, source_id string, ts timestamp")
    assert {r.id: r.found for r in duplicates.latest_before(p, e).collect()} == {"a": "e1"}


def _us(t):
    return None if t is None else int((t - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def _item(**of):
    return of | {"published_at": _us(of.get("published_at"))}


def test_event_fold():
    e = saving.Event()
    e.add(_item(source_id="a", external_id="1", source_name="A", content="אזעקות נשמעו בקריית שמונה ובסביבה", severity="high", published_at=T))
    e.add(_item(source_id="a", external_id="1", source_name="A", content="אזעקות נשמעו בקריית שמונה ובסביבה", severity="low", published_at=T))
    assert (e.sources, e.severity, e.content.count("\n")) == (1, "high", 0)
    e.add(_item(source_id="b", external_id="2", source_name="B", source_url="u", content="פצוע פונה לבית החולים בצפת", severity="critical", published_at=T - timedelta(minutes=5), media=["m1", "m1", None, "m2"]))
    assert (e.sources, e.severity, e.source_name, e.source_id, e.source_url, e.external_id) == (2, "critical", "B", "b", "u", "2") and "עדכון (B, 13:55:00): פצוע" in e.content
    assert e.media == ["m1", "m2"]
    # A day earlier is no earlier report of this event.
    e.add(_item(source_id="c", external_id="3", source_name="C", content="נזק", published_at=T - timedelta(days=2)))
    assert e.source_name == "B"
    e.add(_item(source_id="d", external_id="4", content="האירוע הסתיים", severity="critical"), summarize=lambda t: "תמצית")
    assert (e.status, e.severity, e.sources) == ("dismissed", "low", 4) and e.content.endswith("\n\n\nסיכום: תמצית")
    e.add(_item(source_id="d", external_id="5", content="חזרה לשגרה בכל האזור עכשיו"), summarize=lambda t: "עוד אחת")
    assert e.content.count("סיכום:") == 1
    e.add(_item(source_id="e", external_id="6", content=None, severity="high", published_at=T))
    assert (e.status, e.severity) == ("dismissed", "high")


def test_lines_nearly_the_same_are_not_told_again():
    """A note nearly the same as one line of a long event is a repetition, however little of the whole event it is."""
    lines = [f"שורה מספר {i} על עניין אחר לגמרי ובו פרטים רבים" for i in range(9)] + ["מגן דוד אדום פינה שלושה פצועים במצב בינוני לבית החולים"]
    e = saving.Event(content="\n".join([lines[0]] + [f"עדכון (מקור, 10:00:0{i}): {x}" for i, x in enumerate(lines[1:])]))
    same = "מגן דוד אדום פינה שלושה פצועים במצב בינוני לבית החולים הקרוב"
    assert e.tells(saving.tokens_of(same)) and not e.tells(saving.tokens_of("כבאים משתלטים על דליקה שפרצה במחסן"))
    assert not saving.Event().tells(saving.tokens_of(same))
    again = saving.Event.of(e.json())
    assert again.lines == e.lines and again.tokens == e.tokens and all("מקור" not in line for line in e.lines[1:])


def test_restored_events_go_on_as_if_never_stored():
    texts = ["אזעקות נשמעו בקריית שמונה ובסביבה", "פצוע פונה לבית החולים בצפת", "עוד פצוע פונה לבית החולים בצפת הבוקר", "דליקה פרצה בשטח פתוח ליד הגדר"]
    whole, stepwise = saving.Event(), saving.Event()
    for i, t in enumerate(texts):
        item = _item(source_id="s", external_id=str(i), source_name="S", content=t, published_at=T + timedelta(minutes=i))
        whole.add(item)
        stepwise = saving.Event.of(stepwise.json())
        stepwise.add(item)
    assert whole.json() == stepwise.json() and whole.content.count("\n") == 2


def test_folded_equals_the_fold(spark):
    rows = [(f"r{i % 3}" if i % 7 else None, f"i{i:02}", f"s{i % 4}", f"S{i % 4}", str(i % 5), None, f"טקסט מספר {i % 6} על אירוע", "low" if i % 4 else "high", T + timedelta(minutes=(i * 37) % 50)) for i in range(40)]
    columns = "report_id string, id string, source_id string, source_name string, external_id string, title string, content string, severity string, published_at timestamp"
    got = {r.report_id: r for r in events.folded(spark.createDataFrame(rows, columns)).collect()}
    names = [c.split(" ")[0] for c in columns.split(", ")]
    for key in ("r0", "r1", "r2"):
        e = saving.Event()
        for row in sorted((r for r in rows if r[0] == key), key=lambda r: (r[8], r[1])):
            e.add(_item(**dict(zip(names, row))))
        assert (got[key].content, got[key].severity, got[key].sources, _us(got[key].first_at)) == (e.content, e.severity, e.sources, e.occurred_at)
    assert events.folded(spark.createDataFrame([], columns)).count() == 0


def test_stale_close(spark):
    df = spark.createDataFrame([(1, "high", "verified", T - timedelta(hours=3)), (2, "high", "verified", T - timedelta(hours=3, seconds=1)), (3, "high", None, T - timedelta(days=1)), (4, "high", "dismissed", T - timedelta(days=1)), (5, "high", "verified", None)], "id int, severity string, status string, published_at timestamp")
    got = {r.id: (r.severity, r.status, r.closed) for r in events.closed_if_stale(df, F.lit(T)).collect()}
    assert got[2] == ("low", "dismissed", True) and [got[i][2] for i in (1, 3, 4, 5)] == [False] * 4


def test_gallery_and_corroboration(spark):
    df = spark.createDataFrame([("a", f"u{i % 10}", T + timedelta(seconds=100 - i)) for i in range(30)] + [("a", None, T), ("a", "", T), (None, "u", T)], "k string, u string, at timestamp")
    assert events.gallery(df, "k", "u", "at").first().media == [f"u{i}" for i in range(9, 1, -1)]
    bridge = spark.createDataFrame([("r", "s", "1", T), ("r", "s", "1", T), ("r", None, "1", T + timedelta(1)), (None, "s", "1", T)], "report_id string, source_id string, external_id string, published_at timestamp")
    assert events.corroboration(bridge).first().sources == 2


def test_health(spark):
    log = spark.createDataFrame([(1, "s", T, True, None), (2, "s", T + timedelta(1), False, "x" * 600), (2, "s", T + timedelta(1), False, "x" * 600), (3, None, T, False, "e")], "id long, source_id string, run_at timestamp, ok boolean, error string")
    got = {r.source_id: r for r in operations.health(log).collect()}
    assert (len(got["s"].last_error), got["s"].failures, got[None].failures, got[None].last_success_at) == (500, 1, 1, None)


def test_near_line(spark):
    note, lines = F.array(F.lit("a"), F.lit("b")), F.array(F.array(F.lit("x")), F.array(F.lit("a"), F.lit("c")))
    assert spark.range(1).select(tokens.near_line(note, lines), tokens.near_line(note, F.array(F.array(F.lit("x"))))).first()[:] == (True, False)


def test_enriched(spark, gazetteer):
    df = spark.createDataFrame([(1, "פיגוע בקריית שמונה! פרטים בהמשך", "x"), (2, None, "y"), (3, "plain words here", "z")], "id int, t string, extra string")
    got = {r.id: r for r in enrich.enriched(df, "id", "t", places.gazetteer(*gazetteer)).collect()}
    assert (got[1].location_name, got[1].severity, got[1].title, got[1].lang, got[1].extra) == ("קריית שמונה", "critical", "פיגוע בקריית שמונה!", "he", "x")
    assert (got[2].content, got[2].title, got[3].lang) == ("", "דיווח ללא כותרת", "other") and len({r.dedup_key for r in got.values()}) == 3


def test_judged_same(spark):
    columns = "id string, ts timestamp, content string, place string, tokens array<string>"
    items = spark.createDataFrame([("a", T, "one", "p", ["x"]), ("b", T, "two", "p", ["y"]), ("c", T + timedelta(hours=5), "three", None, []), ("d", None, "four", None, [])], columns)
    seen = spark.createDataFrame([(f"e{i}", T + timedelta(minutes=3 * i), f"c{i}", "p" if i == 5 else "q", ["x"] if i == 4 else []) for i in range(9)], columns)
    def judge(content, candidates):
        return candidates.index("c5") if content == "one" else 9

    assert [tuple(r) for r in enrich.judged_same(items, seen, judge).collect()] == [("a", "e5")]


def test_judged_candidates_are_the_newest_within_the_window(spark):
    import random

    r = random.Random(2)
    columns = "id string, ts timestamp, content string, place string, tokens array<string>"
    rows = [(f"e{i:02}", T + timedelta(minutes=r.randint(0, 240)), f"c{i}", None, []) for i in range(60)]
    asked = spark.sparkContext.accumulator(0)
    got = {}

    def judge(content, candidates):
        asked.add(1)
        return next((k for k, c in enumerate(candidates) if c == "c7"), None)

    df = spark.createDataFrame(rows, columns)
    for x in enrich.judged_same(df, df, judge).collect():
        got[x.id] = x.other
    want = {}
    for a in rows:
        near = sorted((b for b in rows if b[0] != a[0] and abs(a[1] - b[1]) <= timedelta(minutes=20)), key=lambda b: (b[1], b[0]), reverse=True)[:6]
        if "c7" in [b[2] for b in near]:
            want[a[0]] = "e07"
    assert got == want and want


def test_busy_tokens_are_salted(spark):
    rows, df = _events(spark)
    whole = {tuple(r) for r in duplicates.tight_earlier(df).collect()}
    assert {tuple(r) for r in duplicates.tight_earlier(df, hot=3).collect()} == whole and whole
    some = {(r.id, r.other): r.score for r in duplicates.eligible_earlier(df).collect()}
    similar = {(r.id, r.other): r.score for r in duplicates.similar_earlier(df).collect()}
    assert set(some) == set(similar) | {(a, b) for a, b, _ in whole} and all(some[k] == v for k, v in similar.items())


def test_best_without_pairs(spark):
    rows, df = _events(spark)
    same = [(f"t{i}", T, ["w3", "w4", f"w{5 + i % 3}"], "p", ["w3"]) for i in range(12)]  # ties in time and in score
    df = df.union(spark.createDataFrame(same, df.schema))
    for hot in (100_000, 3):
        for pairs, best in ((duplicates.similar_earlier(df), duplicates.best_similar(df, hot=hot)), (duplicates.eligible_earlier(df), duplicates.best_eligible(df, hot=hot))):
            want = {tuple(r) for r in duplicates.best_earlier(df, pairs).collect()}
            assert {tuple(r) for r in best.collect()} == want and want
        links = {}
        for r in duplicates.tight_earlier(df).collect():
            n, most = links.get(r.id, (0, 0))
            links[r.id] = (n + 1, max(most, r.shared))
        assert {r.id: (r.links, r.shared) for r in duplicates.tight_links(df, hot=hot).collect()} == links and links
    # Chunks are cut at multiples of twice the window; pairs reach over the cut, both ends of the window included.
    edge = [("a", datetime(2026, 1, 1, 0, 0), ["w1", "w2"], None, []), ("b", datetime(2026, 1, 1, 5, 59, 59, 999999), ["w1", "w2"], None, []), ("c", datetime(2026, 1, 1, 6, 0), ["w1", "w2"], None, []), ("d", datetime(2026, 1, 1, 12, 0, 0, 1), ["w1", "w2"], None, [])]
    edge = spark.createDataFrame(edge, df.schema)
    for shift in range(0, 14, 2):
        moved = edge.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {shift} HOURS"))
        assert {tuple(r) for r in duplicates.similar_earlier(moved).select("id", "other").collect()} == {("b", "a"), ("c", "a"), ("c", "b")}


def test_what_is_shuffled_does_not_grow_with_the_pairs(spark, tmp_path):
    """no exchange of pairs, however many there are."""
    from tidings.plans import catalog

    rows = [(f"r{i:03}", T + timedelta(seconds=i), "אזעקות הופעלו בעיר ובכפרים הסמוכים", None) for i in range(200)]
    spark.createDataFrame(rows, "id string, published_at timestamp, content string, location_name string").write.parquet(str(tmp_path / "reports.parquet"))
    for name in ("duplicate_candidates", "tight_window_links", "similar_earlier_reports"):
        made = catalog.QUERIES[name](spark, str(tmp_path))
        found = {r.id: r for r in made.collect()}
        assert len(found) == 199 and all(found[f"r{i:03}"].links == i for i in range(1, 200))
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.split("Initial Plan")[0].count("Exchange") == 1


def test_asof_matches_brute_force(spark):
    import random

    r = random.Random(6)
    probes = [(f"p{i}", r.choice(["s", "t", None]), r.choice([None] + [T + timedelta(minutes=r.randint(0, 200))] * 9)) for i in range(80)]
    told = [(f"r{i % 30}", r.choice(["s", "t", None]), r.choice([None] + [T + timedelta(minutes=r.randint(0, 200))] * 9)) for i in range(80)]
    reports = [(f"r{i}", T + timedelta(minutes=7 * i)) for i in range(25)]
    got = {x.id: (x.report_id, x.told_at) for x in duplicates.latest_report(spark.createDataFrame(probes, "id string, source_id string, ts timestamp"), spark.createDataFrame(told, "report_id string, source_id string, published_at timestamp"), spark.createDataFrame(reports, "id string, created_at timestamp")).collect()}
    want = {}
    for i, s, t in probes:
        rows = [(at, x) for x, src, at in told if src == s and at] if s else [(at, x) for x, at in reports]
        rows = [(at, x) for at, x in rows if t and t - timedelta(minutes=15) <= at <= t]
        if rows and max(rows)[1] in dict(reports):
            want[i] = max(rows)[::-1]
    assert got == want and len(want) > 20


def test_official_sources_pass_as_they_are(spark):
    columns = "id int, title string, content string, severity string, status string, place string, source_type string, raw struct<channel:string,filter:string,promoted:boolean>"
    rows = [(1, "plain", "words", "high", "new", None, "OREF", None), (2, "אזעקה דחוף בצפון", "", "low", "verified", None, "rss", ("c", None, None)), (3, "plain", None, "low", "verified", None, None, None)]
    got = {r.id: r for r in screening.screened(spark.createDataFrame(rows, columns), PACK, place="place", official=("oref",), raw="raw").collect()}
    assert (got[1].keep, got[1].reason, got[1].content, got[1].severity, got[1].status, got[1].filter, got[1].raw) == (True, "official", "words", "high", "new", "none", None)
    assert got[2].keep and tuple(got[2].raw) == ("c", "heuristic", True)
    assert not got[3].keep and got[3].raw is None


def test_judges_in_a_chain_and_rule_counts():
    def broken(text):
        raise RuntimeError

    assert screening.judge_chain(lambda t: None, broken, lambda t: {"relevant": True})("x") == {"relevant": True}
    assert screening.judge_chain(broken)("x") is None
    assert screening.rule_counts(PACK) == {"suppress": 2, "promote": 1, "review": 1}


def test_sessions_and_outcomes(spark):
    rows = [("r", T), ("r", T + timedelta(hours=3)), ("r", T + timedelta(hours=6, seconds=1)), (None, T), ("s", None)]
    got = sorted((r.started, r.items) for r in events.sessions(spark.createDataFrame(rows, "k string, at timestamp"), "k", "at").collect())
    assert got == [(T, 2), (T + timedelta(hours=6, seconds=1), 1)]
    bridge = spark.createDataFrame([("r", "s", "1", T, "a"), ("r", "s", "1", T, "b"), ("r", "t", "2", T + timedelta(1), "c"), ("q", None, None, None, "d")], "report_id string, source_id string, external_id string, published_at timestamp, id string")
    assert sorted((r.source_id or "", r.outcome) for r in operations.message_outcomes(bridge).collect()) == [("", "inserted"), ("s", "inserted"), ("s", "skipped"), ("t", "deduped")]

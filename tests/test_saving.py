"""The save operator against a plain restatement, and batches of one item against one batch."""

import random
from datetime import datetime, timedelta

from tidings.functions import lexicon as X
from tidings.operators import saving
from tidings.sources.shared import kept

T = datetime(2026, 1, 1, 12)
COLUMNS = "id string, region string, source_id string, source_name string, source_url string, external_id string, title string, content string, severity string, status string, place string, published_at timestamp, arrived_at timestamp, media array<string>"
WORDS = ["אזעקות", "יירוט", "שריפה", "מחבל", "גדר", "כביש", "רכב", "פצוע", "שיגור", "מבנה", "כיתה", "מסוק", "רחפן", "נמל", "שדה"]


def make(n, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        at = T + timedelta(minutes=i * 4)
        content = " ".join(r.sample(WORDS, r.randint(2, 5)))
        kind = r.random()
        if kind < 0.15:
            content = r.choice(["האירוע הסתיים", "ללא נפגעים", "חזרה לשגרה"])
        elif kind < 0.2:
            content = r.choice([None, ""])
        source = r.choice(["a", "b", "c", None])
        rows.append((
            f"i{i:03}", r.choice("xy"), source, source and source.upper(), None, r.choice([str(i), str(i), "7", None]), "כותרת " + (content or "")[:20], content, r.choice(["low", "medium", "high", "critical", None]), None,
            r.choice(["חיפה", "צפת", None, ""]), r.choice([at, at - timedelta(minutes=r.randint(0, 60)), None]), at, r.choice([None, [f"u{i}"], ["u1", "u1"]]),
        ))
    return rows


def plain(rows):
    """Outcome of each item, and sources and content of each event, item by item over lists."""
    names = [c.split(" ")[0] for c in COLUMNS.split(", ")]
    seen, events, told, out = set(), {}, [], {}
    for row in sorted(rows, key=lambda x: (x[12], x[0])):
        i = dict(zip(names, row))
        key = (i["source_id"], i["external_id"])
        if None not in key:
            if key in seen:
                out[i["id"]] = ("skipped", None)
                continue
            seen.add(key)
        text, at, now, own = i["content"] or "", i["published_at"], i["arrived_at"], saving.tokens_of(i["content"] or "")
        mine = [e for e in events.values() if e["region"] == i["region"]]
        short = any(t and len(t) <= 60 and any(m in t for m in X.FOLLOW_UP + X.RESOLVED) for t in ((i["title"] or "").strip(), text.strip()))
        hit = None
        if short:
            ref = at or now
            if i["source_id"] is not None:
                near = [(t, x, e) for t, s, x, e in told if s == i["source_id"] and ref - timedelta(minutes=15) <= t <= ref and events[e]["region"] == i["region"]]
                hit = events[max(near)[2]] if near else None
            else:
                near = [(e["made"], e["id"]) for e in mine if ref - timedelta(minutes=15) <= e["made"] <= ref]
                hit = events[max(near)[1]] if near else None
            if hit is None:
                out[i["id"]] = ("skipped", None)
                continue
        else:
            recent = sorted((e for e in mine if e["at"] is not None and e["at"] >= now - timedelta(hours=6)), key=lambda e: (e["at"], e["id"]), reverse=True)[:40]
            best = 0.0
            for e in recent:
                other = saving.tokens_of(e["content"])
                score = len(own & other) / len(own | other) if own and other else 0.0
                fits = score >= 0.3
                if not fits and at and (not i["place"] or not e["place"] or i["place"] == e["place"]) and abs(at - e["at"]) <= timedelta(minutes=90):
                    fits = len((own & other) - saving.tokens_of(i["place"] or e["place"] or "")) >= (1 if i["place"] or e["place"] else 2)
                if fits and score > best:
                    best, hit = score, e
        if hit is None:
            hit = events[i["id"]] = {"id": i["id"], "region": i["region"], "made": now, "at": at, "place": i["place"], "content": text.strip(), "keys": {(i["source_id"] or "", i["external_id"] or "")}}
            out[i["id"]] = ("inserted", i["id"])
        else:
            out[i["id"]] = ("deduped", hit["id"])
            hit["keys"].add((i["source_id"] or "", i["external_id"] or ""))
            hit["at"] = max(hit["at"] or now, now)
            lines = [saving.tokens_of(saving.UPDATE_PREFIX.sub("", x)) for x in hit["content"].split("\n")]
            near = any(own and x and len(own & x) / len(own | x) >= 0.3 for x in lines)
            if text.strip() and text.strip() not in hit["content"] and (short or not near or not hit["content"]):
                clock = (at + timedelta(hours=2)).strftime("%H:%M:%S") if at else None
                prefix = "עדכון: " if not i["source_name"] else f"עדכון ({i['source_name']}, {clock}): " if clock else f"עדכון ({i['source_name']}): "
                hit["content"] = f"{hit['content']}\n{prefix}{text.strip()}" if hit["content"] else text.strip()
        if i["source_id"] is not None and at is not None:
            told.append((at, i["source_id"], i["external_id"] or "", hit["id"]))
    return out, {k: (len(e["keys"]), e["content"]) for k, e in events.items()}


def test_saved_items_match_a_plain_restatement(spark):
    rows = make(160)
    items = spark.createDataFrame(rows + [], COLUMNS)
    made = kept(saving.saved(items, shard="region"))
    want, events = plain(rows)
    assert {r.item: (r.outcome, r.report_id) for r in saving.outcomes(made).collect()} == want
    got = {r.id: (r.sources, r.content) for r in saving.changed_events(made).collect()}
    assert got == events
    assert {o for o, _ in want.values()} == {"inserted", "deduped", "skipped"}
    bridge = saving.bridge_rows(made, items).collect()
    assert len(bridge) == sum(e is not None for _, e in want.values()) and all(len(r.excerpt) <= 280 for r in bridge)


def test_batches_of_one_item_give_the_same(spark):
    rows = make(24, seed=8)
    whole = kept(saving.saved(spark.createDataFrame(rows, COLUMNS), shard="region"))
    want = {r.id: (r.sources, r.content, r.severity, r.status, r.occurred_at, r.source_name, r.media) for r in saving.changed_events(whole).collect()}
    told = {r.item: (r.outcome, r.report_id) for r in saving.outcomes(whole).collect()}
    events, bridge, seen = {}, [], set()
    for row in rows:
        items = spark.createDataFrame([row], COLUMNS)
        if (row[2], row[5]) in seen and None not in (row[2], row[5]):
            assert told[row[0]][0] == "skipped"
            continue
        seen.add((row[2], row[5]))
        before = spark.createDataFrame([tuple(e) for e in events.values()], saving.EVENT.replace("occurred_at bigint, published_at bigint, created_at bigint", "occurred_at timestamp, published_at timestamp, created_at timestamp") + ", region string") if events else None
        notes = spark.createDataFrame(bridge, "report_id string, source_id string, external_id string, published_at timestamp") if bridge else None
        made = saving.saved(items, before, notes, shard="region").collect()
        for r in made:
            if r["item"] is not None:
                assert (r["outcome"], r["report_id"]) == told[row[0]]
                if r["report_id"]:
                    bridge.append((r["report_id"], row[2], row[5] or "", row[11]))
            else:
                e = r["event"].asDict()
                events[e["id"]] = [None if v is None else datetime(1970, 1, 1) + timedelta(microseconds=v) if k in saving.TIMES else v for k, v in e.items()] + [r["shard"]]
    names = [c.split(" ")[0] for c in saving.EVENT.split(", ")]
    got = {}
    for k, e in events.items():
        e = dict(zip(names, e))
        got[k] = (e["sources"], e["content"], e["severity"], e["status"], e["occurred_at"], e["source_name"], e["media"])
    assert got == want


def test_a_judge_may_name_the_event(spark):
    rows = [("a", "x", "s", "S", None, "1", None, "אזעקות הופעלו בגליל", "high", None, None, T, T, None), ("b", "x", "t", "T", None, "2", None, "נראתה נפילה בשטח פתוח", "low", None, None, T, T + timedelta(minutes=3), None), ("c", "x", "t", "T", None, "3", None, "מכולה נפתחה בנמל", "low", None, "חיפה", T, T + timedelta(minutes=4), None)]
    made = saving.saved(spark.createDataFrame(rows, COLUMNS), judge=lambda text, events: 0 if "נפילה" in text or "מכולה" in text else 5).collect()
    assert {r["item"]: r["report_id"] for r in made if r["item"]} == {"a": "a", "b": "a", "c": "c"}


def test_no_items_and_missing_columns(spark):
    assert saving.saved(spark.createDataFrame([], COLUMNS)).count() == 0
    few = spark.createDataFrame([("a", None, None, "טקסט ארוך על אירוע", None, None)], "id string, source_id string, external_id string, content string, published_at timestamp, arrived_at timestamp")
    assert [(r["outcome"], r["report_id"]) for r in saving.saved(few).collect() if r["item"]] == [("inserted", "a")]


def test_no_item_looks_at_all_events_held():
    """what an item costs must not grow with the events that are held."""

    class Held(dict):
        def values(self):
            raise AssertionError("all events were looked at")

    at = lambda n: 1_700_000_000_000_000 + n * saving.MINUTE
    desk = saving.Desk(events=Held())
    for n in range(3_000):
        desk.forget(at(n))
        item = {"id": f"i{n:04}", "source_id": f"s{n % 3}", "external_id": str(n), "content": f"אירוע{n} נוסף{n} בכביש{n}", "published_at": at(n)}
        assert desk.save(item, at(n)) == ("inserted", item["id"])
        assert desk.latest("s0", at(n)).id == f"i{n - n % 3:04}" and desk.latest(None, at(n)).id == item["id"]
    assert len(desk.events) == 24 * 60 + 1 and len(desk._recent) == len(desk._made) == len(desk._held) == len(desk.events)
    assert sum(map(len, desk.told.values())) < 2 * len(desk.events) + 10


def test_long_events_are_searched_as_short_ones():
    """an event of many lines is looked up in an index, with the same answers as a search from end to end."""
    r = random.Random(5)
    line = lambda: " ".join(r.choice(WORDS[:5]) for _ in range(r.randint(1, 7)))
    text, lines, whole, sets = saving._Text(""), saving._Lines(), [], []
    for k in range(300):
        new = line() + r.choice(["", "", "\n" + line(), "  " + line()])
        asked = r.choice([line(), new, new[1:-1], new[2:], line() + "\n" + line(), " " + new, whole[-1][-9:] + "\n" + new[:3] if whole else new])
        assert text.holds(asked) == (asked in "\n".join(whole)), (k, asked)
        own = frozenset(r.sample(WORDS, r.randint(0, 6)))
        assert lines.near(own) == any(saving.jaccard(own, x) >= saving.NEAR for x in sets if x)
        text.append(new) if whole else text.__init__(new)
        whole.append(new)
        sets.append(frozenset(r.sample(WORDS, r.randint(1, 9))) if k > 40 else frozenset(r.sample(WORDS, 9)))
        lines.add(sets[-1])
        assert str(text) == "\n".join(whole)
    assert text.of_pair and lines.of_token and not lines.few


def test_outcomes_alone_of_rows_stored_twice(spark):
    """outcomes need no rows of events, and rows stored twice count once, in the same shuffle as messages seen before."""
    rows = make(160)
    made = saving.saved(spark.createDataFrame(rows + rows, COLUMNS), shard="region", states=False, distinct=True)
    got = made.collect()
    assert len(got) == len(rows) and {r.item: (r.outcome, r.report_id) for r in got} == plain(rows)[0]
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 2


def test_updates_are_learnt_without_cleaning_them_again():
    """an update's tokens are those of its line, prefix and all, whatever the name and the text hold."""
    r = random.Random(9)
    names = ["ערוץ הגליל", "צילום: דן", "News 24", "a@b", "שומרון", "x (1/2/2024", "😀 חדשות", "t.me/abc", "חדשות 55", "אפליקציית דיווח", "ﬁle", "é"]
    parts = ["אזעקות בגליל", "@ערוץ", "#תג", "| צילום: דן", "(5 שניות)", "): 10:30: ירי", "https://a.b/c", "שומרון בטלגרם", "רוצים לפרסם", "😀", "\nשורה נוספת", "3 תגובות", "́מבטא", "ΟΔΟΣ", "12:30", "עדכון (אחר): יירוט"]
    for _ in range(400):
        name, text, at = r.choice([*names, None]), " ".join(r.sample(parts, r.randint(1, 5))).strip(), r.choice([None, 1_700_000_000_000_000])
        e = saving.Event(content="תחילת האירוע")
        e.add({"content": text, "source_name": name, "published_at": at}, note=True)
        if line := e.content.removeprefix("תחילת האירוע").removeprefix("\n"):
            whole = saving.Event(content="תחילת האירוע")
            whole._learn(line)
            assert e.tokens == whole.tokens and e._lines.few == whole._lines.few, (name, text)
    before = saving.matchable_literal.cache_info().misses
    e.add({"content": "רחפן נצפה מעל הנמל", "source_name": "ערוץ הגליל", "published_at": 1_700_000_000_000_000}, note=True)
    e.add({"content": "מסוק נחת בשדה פתוח", "source_name": "ערוץ הגליל", "published_at": 1_700_000_060_000_000}, note=True)
    assert saving.matchable_literal.cache_info().misses - before <= 3  # two texts and a name


def test_the_most_similar_event_is_found_whatever_its_size():
    """events much larger than the item are compared last, with the same answer; of equal similarity the newest."""
    r = random.Random(11)
    at = lambda n: 1_700_000_000_000_000 + n * saving.MINUTE
    tied = 0
    for k in range(300):
        desk = saving.Desk()
        for n in range(8):
            content = " ".join(r.sample(WORDS, r.randint(1, 4)) + ([f"מילה{x}" for x in range(90)] if r.random() < 0.4 else []))
            desk.hold(saving.Event(id=f"e{n}", content=content, published_at=at(n * 12), created_at=at(n), place=r.choice([None, "חיפה", "צפת"])))
        item = {"id": "i", "content": " ".join(r.sample(WORDS, r.randint(1, 5))), "published_at": at(100), "place": r.choice([None, "חיפה"])}
        own, best, score = saving.tokens_of(item["content"]), None, 0.0
        for e in sorted(desk.events.values(), key=lambda e: -e.published_at):
            s = saving.jaccard(own, e.tokens)
            places = not item["place"] or not e.place or item["place"] == e.place
            close = places and at(100) - e.published_at <= 90 * saving.MINUTE and len((own & e.tokens) - saving.tokens_of(item["place"] or e.place or "")) >= (1 if item["place"] or e.place else 2)
            tied += bool(s and s == score and (s >= saving.NEAR or close))
            if s > score and (s >= saving.NEAR or close):
                best, score = e, s
        assert desk.same(item, at(100)) is best, k
    assert tied


def test_lines_of_an_indexed_event_can_be_read():
    """the index gives the token sets of all lines back."""
    r = random.Random(4)
    e = saving.Event(content="\n".join(" ".join(r.sample(WORDS, 4)) for _ in range(40)))
    assert e._lines.of_token and e.lines == [saving.tokens_of(x) for x in e.content.split("\n")]
    assert saving.Event.of(e.json()).lines == e.lines and saving.Event().lines == []


def test_all_events_of_the_window_are_looked_at(spark):
    """F1 (saved_events): an item joins its event however many newer ones the window has."""
    own = lambda n: f"מבנה{n} כביש{n} רכב{n} נמל{n}"
    rows = [(f"i{n:03}", "x", "s", "S", None, str(n), None, own(n % 100), "low", None, None, T + timedelta(minutes=n), T + timedelta(minutes=n), None) for n in range(200)]
    made = kept(saving.saved(spark.createDataFrame(rows, COLUMNS), shard="region"))
    assert {r.item: (r.outcome, r.report_id) for r in saving.outcomes(made).collect()} == {f"i{n:03}": ("deduped" if n > 99 else "inserted", f"i{n % 100:03}") for n in range(200)}
    assert {r.id: r.sources for r in saving.changed_events(made).collect()} == {f"i{n:03}": 2 for n in range(100)}


def test_events_are_found_by_token_as_one_by_one():
    """F1 (saved_events): the index of a full window gives the event that a search of all of it gives, while events come, grow and go."""
    r = random.Random(6)
    at = lambda n: 1_700_000_000_000_000 + n * saving.MINUTE
    words = [f"{w}{n}" for w in WORDS[:8] for n in range(25)] + ["חיפה", "צפת"]
    desk, found, full, old = saving.Desk(), 0, 0, 0
    for k in range(3_000):
        now = at(k * (8 if k // 600 % 2 else 1))
        desk.forget(now)
        item = {
            "id": f"i{k - 40 if k % 50 == 0 and k > 40 else k}", "source_id": "s", "external_id": str(k), "content": " ".join(r.sample(words, r.randint(0, 9))), "place": r.choice([None, None, "חיפה", "צפת", ""]),
            "published_at": r.choice([now, now - r.randint(0, 200) * saving.MINUTE, now, None]),
        }
        own = saving.tokens_of(item["content"])
        recent = sorted((e for e in desk.events.values() if e.published_at is not None and e.published_at >= now - 6 * saving.HOUR), key=lambda e: (e.published_at, e.id), reverse=True)
        best, score = None, 0.0
        for e in recent:
            s, common, place = saving.jaccard(own, e.tokens), own & e.tokens, item["place"] or e.place
            fits = item["published_at"] is not None and abs(item["published_at"] - e.published_at) <= 90 * saving.MINUTE and (not item["place"] or not e.place or item["place"] == e.place)
            if s > score and (s >= saving.NEAR or fits and len(common - saving.tokens_of(place or "")) >= (1 if place else 2)):
                best, score = e, s
        assert desk.same(item, now) is best, k
        found, full, old = found + (best is not None), full + (len(recent) > 40), old + (best in recent[40:])
        desk.save(item, now)
    assert found > 100 and full > 100 and old > 50


def test_late_follow_ups_find_what_their_source_told(spark):
    """F1 (saved_events): a follow-up that arrives days later goes to what its source told of then, as one that comes at once."""
    rows, r = make(160), random.Random(2)
    for i, row in enumerate(rows):
        if r.random() < 0.3:
            at = row[12] - timedelta(minutes=r.randint(0, 3))
            rows[i] = (*row[:7], r.choice(["האירוע הסתיים", "ללא נפגעים", "ללא נפגעים", row[7]]), *row[8:11], at, row[12] + timedelta(days=r.choice([2, 3, 9]), minutes=i), row[13])
    made = kept(saving.saved(spark.createDataFrame(rows, COLUMNS), shard="region"))
    want, events = plain(rows)
    assert {x.item: (x.outcome, x.report_id) for x in saving.outcomes(made).collect()} == want
    assert {x.id: (x.sources, x.content) for x in saving.changed_events(made).collect()} == events
    late = [(x[2] is None, want[x[0]][0]) for x in rows if x[11] and x[12] - x[11] > timedelta(days=1) and saving.is_follow_up({"content": x[7]})]
    assert {(False, "deduped"), (True, "deduped"), (False, "skipped"), (True, "skipped")} == set(late) and len([x for x in late if x[1] == "deduped"]) > 5


def test_a_late_follow_up_reaches_the_event_of_an_earlier_batch(spark):
    """F1 (saved_events): what it may ask for is read, too."""
    e = ("e", "t", "אזעקות בגליל", "low", "verified", 1, T, T, T, "s", "S", None, "1", None, None)
    before = spark.createDataFrame([e], saving.EVENT.replace("occurred_at bigint, published_at bigint, created_at bigint", "occurred_at timestamp, published_at timestamp, created_at timestamp"))
    notes = spark.createDataFrame([("e", "s", "1", T)], "report_id string, source_id string, external_id string, published_at timestamp")
    rows = [("a", None, "u", "U", None, "2", None, "נראתה נפילה בשטח פתוח", None, None, None, T + timedelta(days=3), T + timedelta(days=3), None), ("b", None, "s", "S", None, "3", None, "ללא נפגעים", None, None, None, T + timedelta(minutes=5), T + timedelta(days=4), None)]
    made = saving.saved(spark.createDataFrame(rows, COLUMNS), before, notes).collect()
    assert {r.item: (r.outcome, r.report_id) for r in made if r.item} == {"a": ("inserted", "a"), "b": ("deduped", "e")}


def test_only_what_late_follow_ups_ask_for_is_held_for_them():
    """F1 (saved_events): of what is older than a day, one event is held, and until its follow-up has come."""
    at = lambda n: 1_700_000_000_000_000 + n * saving.MINUTE
    desk, late = saving.Desk(), {"id": "late", "source_id": "s1", "external_id": "late", "content": "ללא נפגעים", "published_at": at(105)}
    desk.ask(late, at(4_000))
    for n in range(5_000):
        desk.forget(at(n))
        if n == 4_000:
            assert desk.save(late, at(n)) == ("deduped", "i0105")
        item = {"id": f"i{n:04}", "source_id": f"s{n % 2}", "external_id": str(n), "content": f"אירוע{n} נוסף{n} בכביש{n}", "published_at": at(n)}
        assert desk.save(item, at(n)) == ("inserted", item["id"])
        assert len(desk.events) <= 24 * 60 + 1 + 8  # those that the source told of within 15 minutes before
    desk.forget(at(4_000 + 24 * 60 + 1))
    assert not desk._until and min(desk.events) > "i0105"

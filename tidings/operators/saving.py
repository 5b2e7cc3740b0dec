"""What becomes of an item: a new event, one more source of an event, or nothing.

An item that was seen before is skipped. A short follow-up goes to the latest event of its own source, or is skipped. Any
other item joins the most similar event of the last hours, else a judge may name one, else it opens an event of its own. An
event's content grows with the items that join it, and later items are compared with what it has become, so the outcome
depends on order: the items of a shard go through one task, in order of arrival, and only the events that an item to come may
reach are held. All events of the window are looked at, through an index of their tokens.
Shards (a region, a country, a tenant: whatever never shares events) run side by side; without one there is one shard.

All times are microseconds since 1970, so that an event can be kept as JSON between batches.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import lru_cache
from math import ceil
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import EXCERPT_CHARS, UPDATE_PREFIX, matchable_literal
from ..functions.tokens import STOP, stem_literal
from ..sources.shared import kept

GUARD_HOURS, MEDIA, FOLLOW_UP_CHARS, NEAR = 24, 8, 60, 0.30
WINDOW_HOURS, TIGHT_MINUTES, JUDGE_MINUTES, JUDGE_CANDIDATES, ATTACH_MINUTES = 6, 90, 20, 6, 15
MINUTE, HOUR = 60_000_000, 3_600_000_000
RANK = {s: i for i, s in enumerate(X.SEVERITIES)}
SUMMARY_MARK = "סיכום:"
_STOP, _NONE, _PLAIN = frozenset(STOP), frozenset([""]), re.compile(r"[\w ]+")
#: Lines of an event, and events of the window, from which on they are looked up in an index.
INDEXED = 32


@lru_cache(100_000)
def _token(w: str) -> str:
    """The token of a word, empty if it carries no meaning."""
    if len(w) > 3 and w[0] in X.ATTACHED:
        w = w[1:]
        if len(w) > 3:
            w = w.removeprefix("ה")
    elif len(w) > 3 and w[0] == "ה":
        w = w[1:]
    w = stem_literal(w)
    return w if len(w) > 2 and w not in _STOP else ""


@lru_cache(1_000)
def tokens_of(text: str) -> frozenset[str]:
    """The token set of one text on a Python worker, as tokens.token_set makes it."""
    return frozenset(map(_token, matchable_literal(text).split())) - _NONE


@lru_cache(1_000)
def _tokens_before(name: str) -> frozenset[str] | None:
    """What the prefix of updates of a source adds to the tokens of any text after it (a clock's numbers are too short to count);
    None if the name may run together with the text when they are cleaned: then the whole line has to be read."""
    plain = _PLAIN.fullmatch(name) and not any(sign in name for sign in X.SIGNS)
    return tokens_of(f"עדכון ({name}): ") if plain else None


def jaccard(a: frozenset | set, b: frozenset | set) -> float:
    n = len(a & b)
    return n / (len(a) + len(b) - n) if n else 0.0


def is_follow_up(item: dict) -> bool:
    texts = [(item.get(k) or "").strip() for k in ("title", "content")]
    return any(t and len(t) <= FOLLOW_UP_CHARS and any(m in t for m in (*X.FOLLOW_UP, *X.RESOLVED)) for t in texts)


def _clock(micros: int, zone: str) -> str:
    t = datetime.fromtimestamp(micros / 1e6, timezone.utc).astimezone(ZoneInfo(zone))
    return f"{t.hour:02}:{t.minute:02}:{t.second:02}"


class _Text:
    """A text that grows by lines, and whether it holds another one. A long text is not searched from end to end: words inside
    the other text, with blanks on both sides, stand side by side in one of its lines, so pairs of words lead to the lines."""

    def __init__(self, text: str) -> None:
        self.lines = text.split("\n") if text else []
        self.joined: str | None = text
        self.of_pair: dict[int, array] | None = None
        self.searched: dict[str, int] = {}

    def __bool__(self) -> bool:
        return bool(self.lines)

    def __str__(self) -> str:
        if self.joined is None:
            self.joined = "\n".join(self.lines)
        return self.joined

    def append(self, text: str) -> None:
        self.joined, self.lines = None, self.lines or [""]
        for line in text.split("\n"):
            if self.of_pair is not None:
                self._index(line, len(self.lines))
            self.lines.append(line)
        if self.of_pair is None and len(self.lines) > INDEXED:
            self.of_pair = {}
            for i, line in enumerate(self.lines):
                self._index(line, i)

    def _index(self, line: str, i: int) -> None:
        words = line.split(" ")
        for pair in set(map(hash, zip(words, words[1:]))):
            if (found := self.of_pair.get(pair)) is None:
                found = self.of_pair[pair] = array("i")
            found.append(i)

    def holds(self, text: str) -> bool:
        if self.of_pair is None:
            return text in str(self)
        if "\n" in text:
            return all(self.holds(x) for x in text.split("\n") if x) and text in str(self)
        words = text.split(" ")[1:-1]
        if len(words) > 1:
            pairs = list(map(hash, zip(words, words[1:])))
            return all(map(self.of_pair.__contains__, pairs)) and any(text in self.lines[i] for i in min(map(self.of_pair.get, pairs), key=len))
        # Few words: only lines that came since the text was last looked for; -1: it was found, and nothing is ever taken out.
        at = self.searched.get(text, 0)
        if at >= 0:
            at = self.searched[text] = -1 if any(text in line for line in self.lines[at:]) else len(self.lines)
        return at < 0


class _Lines:
    """The token sets of an event's lines: as they are while they are few, else the lines of each token."""

    def __init__(self) -> None:
        self.few: list[frozenset] = []
        self.sizes = array("q")
        self.of_token: dict[str, array] = {}

    def add(self, own: frozenset) -> None:
        if len(self.sizes) == INDEXED:
            for i, line in enumerate(self.few):
                self._index(line, i)
            self.few = []
        if len(self.sizes) < INDEXED:
            self.few.append(own)
        else:
            self._index(own, len(self.sizes))
        self.sizes.append(len(own))

    def _index(self, own: frozenset, i: int) -> None:
        for token in own:
            if (found := self.of_token.get(token)) is None:
                found = self.of_token[token] = array("q")
            found.append(i)

    def sets(self) -> list[frozenset]:
        if len(self.sizes) <= INDEXED:
            return self.few
        out: list[set] = [set() for _ in self.sizes]
        for token, lines in self.of_token.items():
            for i in lines:
                out[i].add(token)
        return [frozenset(x) for x in out]

    def near(self, own: frozenset) -> bool:
        for line in self.few:
            n = len(own & line)
            if n and n >= NEAR * (len(own) + len(line) - n):
                return True
        found = b"".join(filter(None, map(self.of_token.get, own)))
        if not found:
            return False
        n, size = np.bincount(np.frombuffer(found, np.int64)), len(own)
        # The line with the most tokens in common mostly decides; no union is smaller than the text's own tokens.
        top = n.argmax()
        most, least = int(n[top]), ceil(NEAR * size)
        if most < least:
            return False
        if most >= NEAR * (size + self.sizes[top] - most):
            return True
        some = (n >= least).nonzero()[0]
        n = n[some]
        return bool((n >= NEAR * (size + np.frombuffer(self.sizes, np.int64)[some] - n)).any())


@dataclass
class Event:
    """One event as it stands; add() takes the next item. Null keys of a source count as one value."""

    id: str | None = None
    title: str | None = None
    content: str = ""
    severity: str = "low"
    status: str = "verified"
    sources: int = 0
    occurred_at: int | None = None
    published_at: int | None = None
    created_at: int | None = None
    source_id: str | None = None
    source_name: str | None = None
    source_url: str | None = None
    external_id: str | None = None
    place: str | None = None
    media: list[str] = field(default_factory=list)
    zone: str = "Asia/Jerusalem"
    keys: set = field(default_factory=set)
    tokens: set = field(default_factory=set)
    _lines: _Lines = field(default_factory=lambda: _Lines(), repr=False, compare=False)
    _new: list[str] | None = field(default=None, repr=False, compare=False)  # tokens since the event was last put in an index

    def __post_init__(self) -> None:
        if self.content:
            self._learn(self.content)

    def _learn(self, text: str) -> None:
        """Token sets of the text's lines, without the prefix of updates, and of the whole text with it."""
        self._have(tokens_of(text))
        for line in text.split("\n"):
            own = tokens_of(UPDATE_PREFIX.sub("", line).strip())
            if own:
                self._lines.add(own)

    def _have(self, tokens: frozenset) -> None:
        if new := tokens - self.tokens:
            self.tokens |= new
            if self._new is not None:
                self._new += new

    @property
    def lines(self) -> list[frozenset]:
        return self._lines.sets()

    def tells(self, own: frozenset) -> bool:
        """Whether a line of the event is nearly the same."""
        return self._lines.near(own)

    def add(self, item: dict, note: bool = False, now: int | None = None, summarize: Callable[[str], str | None] | None = None) -> None:
        text, at = (item.get("content") or "").strip(), item.get("published_at")
        key = tuple("" if item.get(k) is None else str(item[k]) for k in ("source_id", "external_id"))
        if key not in self.keys:
            self.keys.add(key)
            self.sources += 1
        if RANK.get(item.get("severity") or "low", 0) > RANK.get(self.severity, 0):
            self.severity = item["severity"]
        # The earliest publisher comes first, but never one from more than a day before.
        if at is not None and (self.occurred_at is None or at < self.occurred_at < at + GUARD_HOURS * HOUR):
            self.occurred_at = at
            self.source_id, self.source_name, self.source_url, self.external_id = (item.get(k) for k in ("source_id", "source_name", "source_url", "external_id"))
        bump = at if now is None else now
        if bump is not None:
            self.published_at = bump if self.published_at is None else max(self.published_at, bump)
        self._tell(text, item, at, note)
        if any(map((text or item.get("title") or "").__contains__, X.RESOLVED)):
            if summarize is not None and SUMMARY_MARK not in self.content and (told := summarize(self.content)):
                self._text.append(f"\n\n{SUMMARY_MARK} {told}")
                self._learn(f"{SUMMARY_MARK} {told}")
            self.status, self.severity = "dismissed", "low"
        for url in item.get("media") or ():
            if url and url not in self.media and len(self.media) < MEDIA:
                self.media.append(url)

    def _tell(self, text: str, item: dict, at: int | None, note: bool) -> None:
        if not text or self._text.holds(text):
            return
        if not self._text:
            self.content = text
            self._learn(text)
            return
        if not note and self.tells(tokens_of(text)):
            return
        name = item.get("source_name")
        line = ("עדכון: " if not name else f"עדכון ({name}, {_clock(at, self.zone)}): " if at is not None else f"עדכון ({name}): ") + text
        self._text.append(line)
        before = _tokens_before(name) if name and "\n" not in text else None
        if before is None:
            self._learn(line)
            return
        own = tokens_of(text)  # as _learn finds them, without cleaning the text again behind its prefix
        self._have(before)
        if own:
            self._have(own)
            self._lines.add(own)

    def json(self) -> str:
        """The event between batches; token sets are made anew from its content."""
        out = {k: v for k, v in self.__dict__.items() if k != "tokens" and k[0] != "_"}
        return json.dumps(out | {"content": self.content, "keys": sorted(self.keys)}, ensure_ascii=False)

    @classmethod
    def of(cls, text: str) -> Event:
        raw = json.loads(text)
        return cls(**raw | {"keys": {tuple(k) for k in raw["keys"]}})


def _set_content(e: Event, text: str) -> None:
    e._text = _Text(text)


#: A text that lines are added to at little cost, joined when it is read.
Event.content = property(lambda e: str(e._text), _set_content)


class _Index:
    """Events by token. Each has a slot; the slot of an event that was taken out has no time left."""

    GONE = -(1 << 62)

    def __init__(self) -> None:
        self.events: list[Event] = []
        self.slots: dict[str, int] = {}
        self.times, self.sizes, self.places = array("q"), array("q"), array("q")
        self.of_token: dict[str, array] = {}
        self.of_place: dict[str, int] = {}

    def put(self, e: Event) -> None:
        """Take in an event, or what has become of it; one without a time is in no window."""
        slot = self.slots.get(e.id)
        if slot is not None and self.events[slot] is not e:
            self.drop(e.id)
            slot = None
        if e.published_at is None:
            return
        if slot is None:
            slot = self.slots[e.id] = len(self.events)
            self.events.append(e)
            self.times.append(0)
            self.sizes.append(0)
            self.places.append(self.of_place.setdefault(e.place, len(self.of_place) + 1) if e.place else 0)
            e._new = list(e.tokens)
        for token in e._new:
            if (found := self.of_token.get(token)) is None:
                found = self.of_token[token] = array("q")
            found.append(slot)
        e._new = []
        self.times[slot], self.sizes[slot] = e.published_at, len(e.tokens)

    def drop(self, id_: str) -> None:
        if (slot := self.slots.pop(id_, None)) is not None:
            self.times[slot] = self.GONE

    def common(self, tokens: Iterable[str]) -> np.ndarray:
        """How many of the tokens the event of each slot has; slots behind the last that has any are left out."""
        found = b"".join(filter(None, map(self.of_token.get, tokens)))
        return np.bincount(np.frombuffer(found, np.int64))

    def best(self, own: frozenset, place: str | None, at: int | None, since: int) -> Event | None:
        """Of the events from `since` on the most similar of those that are similar enough or fit otherwise; the newest of equals."""
        both = self.common(own)
        some = both.nonzero()[0]
        times = np.frombuffer(self.times, np.int64)[some]
        some, times = some[times >= since], times[times >= since]
        if not len(some):
            return None
        n = both[some]
        score = n / (len(own) + np.frombuffer(self.sizes, np.int64)[some] - n)
        fits = score >= NEAR
        if at is not None and not fits.all():
            places, tight = np.frombuffer(self.places, np.int64)[some], np.abs(times - at) <= TIGHT_MINUTES * MINUTE
            if place:
                beside = np.zeros(len(both), np.int64)
                found = self.common(own - tokens_of(place))
                beside[: len(found)] = found
                fits |= tight & ((places == 0) | (places == self.of_place.get(place, -1))) & (beside[some] >= 1)
            else:
                fits |= tight & (n >= np.where(places == 0, 2, 1))
        some, times, score = some[fits], times[fits], score[fits]
        while len(some):
            top = score.max()
            tied = score == top
            for _, _, e in sorted(((t, self.events[i].id, self.events[i]) for i, t in zip(some[tied].tolist(), times[tied].tolist())), key=lambda x: x[:2], reverse=True):
                if top >= NEAR or place or not e.place or (own & e.tokens) - tokens_of(e.place):
                    return e
            some, times, score = some[~tied], times[~tied], score[~tied]
        return None


@dataclass
class Desk:
    """The events of one shard that items may reach, and who told of them when. Time, as given to forget() and save(), does not go back."""

    judge: Callable[[str, list[str]], int | None] | None = None
    summarize: Callable[[str], str | None] | None = None
    window_hours: int = WINDOW_HOURS
    keep_hours: int = GUARD_HOURS
    events: dict[str, Event] = field(default_factory=dict)
    #: Of each source what it told of, by time; the number of the event, so that one opened anew under an old id is another.
    told: dict[str, list[tuple[int, str, str, int]]] = field(default_factory=dict)
    touched: set[str] = field(default_factory=set)
    _held: dict[str, tuple[int, int | None, int | None]] = field(default_factory=dict)  # number, published_at, created_at as sorted
    _recent: list[tuple[int, str]] = field(default_factory=list)
    _made: list[tuple[int, str]] = field(default_factory=list)
    _ages: list[tuple[int, str, int]] = field(default_factory=list)
    _numbers: int = 0
    _horizon: int | None = None
    _index: _Index | None = None  # none while few events are in the window
    #: Follow-ups to come that ask for what is older than `keep_hours` by then: of each source the times asked for and of arrival.
    _asks: dict[str | None, list[tuple[int, int]]] = field(default_factory=dict)
    #: What they may find, as in `told`, and until when an event is held for them.
    _asked: dict[str, list[tuple[int, str, str, int]]] = field(default_factory=dict)
    _until: dict[str, int] = field(default_factory=dict)

    def ask(self, item: dict, now: int) -> None:
        """Take note of a late item to come, before the events it may ask for: they are held until it arrives."""
        if is_follow_up(item):
            insort(self._asks.setdefault(item.get("source_id"), []), (item["published_at"], now))

    def _held_for(self, source_id: str | None, at: int, event_id: str) -> bool:
        """Whether a follow-up to come asks for what the source told then (without a source: for an event made then)."""
        asks = self._asks.get(source_id, ())
        until = max((asks[i][1] for i in range(bisect_left(asks, (at,)), bisect_left(asks, (at + ATTACH_MINUTES * MINUTE + 1,)))), default=None)
        if until is None:
            return False
        self._until[event_id] = max(until, self._until.get(event_id, until))
        return True

    def hold(self, event: Event) -> None:
        """Take in an event, or take note of its new times."""
        number, *times = self._held.get(event.id, (None, None, None))
        for at, rows, old in ((event.published_at, self._recent, times[0]), (event.created_at, self._made, times[1])):
            if at != old:
                if old is not None:
                    del rows[bisect_left(rows, (old, event.id))]
                if at is not None:
                    insort(rows, (at, event.id))
        if number is None:
            number = self._numbers = self._numbers + 1
            heapq.heappush(self._ages, (self._last(event), event.id, number))
        self._held[event.id] = (number, event.published_at, event.created_at)
        self.events[event.id] = event
        if event.created_at not in (None, times[1]):
            self._held_for(None, event.created_at, event.id)
        if self._index is not None:
            self._index.put(event)

    @staticmethod
    def _last(e: Event) -> int:
        return max(x for x in (e.published_at, e.created_at, 0) if x is not None)

    def save(self, item: dict, now: int) -> tuple[str, str | None]:
        """(outcome, event) of an item that was not seen before; now is the time of its arrival."""
        if is_follow_up(item):
            event = self.latest(item.get("source_id"), now if item.get("published_at") is None else item["published_at"])
            if event is None:
                return "skipped", None
            return self._attach(event, item, now, True)
        event = self.same(item, now)
        if event is not None:
            return self._attach(event, item, now, False)
        event = Event(id=item["id"], title=item.get("title"), status=item.get("status") or "verified", created_at=now, place=item.get("place") or None)
        event.add(item | {"title": None, "content": None})
        event.status, event.severity = item.get("status") or "verified", item.get("severity") or "low"
        event.content = (item.get("content") or "").strip()
        event.published_at = item.get("published_at")
        event.source_id, event.source_name, event.source_url, event.external_id = (item.get(k) for k in ("source_id", "source_name", "source_url", "external_id"))
        event._learn(event.content)
        self.hold(event)
        self.touched.add(event.id)
        self._note(item, event)
        return "inserted", event.id

    def _attach(self, event: Event, item: dict, now: int, note: bool) -> tuple[str, str]:
        event.add(item, note, now, self.summarize)
        self.hold(event)
        self.touched.add(event.id)
        self._note(item, event)
        return "deduped", event.id

    def _note(self, item: dict, event: Event) -> None:
        self.tell(item.get("source_id"), item.get("published_at"), str(item.get("external_id") or ""), event.id)

    def tell(self, source_id: str | None, at: int | None, external_id: str, event_id: str) -> None:
        if source_id is not None and at is not None and event_id in self._held:
            rows, row = self.told.setdefault(source_id, []), (at, external_id, event_id, self._held[event_id][0])
            insort(rows, row)
            if self._held_for(source_id, at, event_id):
                insort(self._asked.setdefault(source_id, []), row)
            if self._horizon is not None and rows[len(rows) // 2][0] < self._horizon:
                del rows[: bisect_left(rows, (self._horizon,))]

    def latest(self, source_id: str | None, at: int, minutes: int = ATTACH_MINUTES) -> Event | None:
        """The event that the source told of last, not after `at` and not long before; without a source the one opened last."""
        since = at - minutes * MINUTE
        if source_id is None:
            i = bisect_left(self._made, (at + 1,)) - 1
            return self.events[self._made[i][1]] if i >= 0 and self._made[i][0] >= since else None
        late = self._horizon is not None and since < self._horizon
        for rows, first in ((self.told, self._horizon if late else since), *([(self._asked, since)] if late else [])):
            rows = rows.get(source_id, [])
            for i in range(bisect_left(rows, (at + 1,)) - 1, -1, -1):
                if rows[i][0] < first:
                    break
                if self._held.get(rows[i][2], (None,))[0] == rows[i][3]:
                    return self.events[rows[i][2]]
        return None

    def same(self, item: dict, now: int) -> Event | None:
        """The event of the window that the item is about: the most similar of those that are similar enough, or close in time
        with a token in common beside the place's. Of equal similarity the newest."""
        own, place, at = tokens_of(item.get("content") or ""), item.get("place") or None, item.get("published_at")
        since = now - self.window_hours * HOUR
        first = bisect_left(self._recent, (since,))
        if len(self._recent) - first > INDEXED:
            if self._index is None:
                self._put_in_index(first)
            best = self._index.best(own, place, at, since) if own else None
        else:
            best = self._best([self.events[x] for _, x in self._recent[: first - len(self._recent) - 1 : -1]], own, place, at)
        if best is None and self.judge is not None and at is not None:
            first, end = (bisect_left(self._recent, (x,)) for x in (max(since, at - JUDGE_MINUTES * MINUTE), at + JUDGE_MINUTES * MINUTE + 1))
            near = [self.events[x] for _, x in self._recent[max(first, end - JUDGE_CANDIDATES) : end][::-1]]
            i = self.judge(item.get("content") or "", [e.content for e in near]) if near else None
            if i is not None and 0 <= i < len(near):
                e = near[i]
                if (place and place == e.place) or own & e.tokens or not (place or e.place):
                    best = e
        return best

    @staticmethod
    def _best(recent: list[Event], own: frozenset, place: str | None, at: int | None) -> Event | None:
        """As _Index.best, event by event."""

        def tight(e: Event) -> bool:
            return at is not None and -TIGHT_MINUTES * MINUTE <= at - e.published_at <= TIGHT_MINUTES * MINUTE and (not place or not e.place or place == e.place)

        best, score, first, size = None, 0.0, 0, len(own)
        # Events much larger than the item come last: no similarity is above that of the sizes, so most need no comparison then.
        order = [(i, e, n) for i, e in enumerate(recent) if (n := len(e.tokens))] if own else []
        for i, e, n in [x for x in order if x[2] <= 8 * size] + [x for x in order if x[2] > 8 * size]:
            most = size / n if size < n else n / size
            if most < score or most < NEAR and not tight(e):
                continue
            both = len(common := own & e.tokens)
            s = both / (size + n - both)
            if not both or s < score or s == score and i > first:
                continue
            if s >= NEAR or tight(e) and (len(common - tokens_of(place or e.place)) >= 1 if place or e.place else both >= 2):
                best, score, first = e, s, i
        return best

    def _put_in_index(self, first: int) -> None:
        self._index = _Index()
        for _, id_ in self._recent[first:]:
            self._index.put(self.events[id_])

    def forget(self, now: int) -> list[Event]:
        """Let go of what no later item can reach: events and notes older than `keep_hours`, other than those that late items
        ask for. Returns the events."""
        before = now - self.keep_hours * HOUR
        self._horizon = before if self._horizon is None else max(self._horizon, before)
        old = []
        while self._ages and self._ages[0][0] < before:
            _, id_, number = heapq.heappop(self._ages)
            e = self.events[id_]
            last = max(self._last(e), self._until.get(id_, before) - self.keep_hours * HOUR)
            if last >= before:  # it was added to since, or is asked for
                heapq.heappush(self._ages, (last, id_, number))
                continue
            self._until.pop(id_, None)
            if self._index is not None:
                self._index.drop(id_)
            _, published, created = self._held.pop(id_)
            for at, rows in ((published, self._recent), (created, self._made)):
                if at is not None:
                    del rows[bisect_left(rows, (at, id_))]
            old.append(self.events.pop(id_))
        if self._index is not None:
            first = bisect_left(self._recent, (now - self.window_hours * HOUR,))
            n = len(self._recent) - first
            if n <= INDEXED // 2:
                self._index = None
            elif len(self._index.events) > 3 * n:  # most are out of the window
                self._put_in_index(first)
        return old


ITEM = ("id", "source_id", "source_name", "source_url", "external_id", "title", "content", "severity", "status", "place", "published_at", "media")
EVENT = "id string, title string, content string, severity string, status string, sources int, occurred_at bigint, published_at bigint, created_at bigint, source_id string, source_name string, source_url string, external_id string, place string, media array<string>"
_OUT = f"shard string, item string, outcome string, report_id string, event struct<{EVENT.replace(' ', ':').replace(',:', ',')}>"
TIMES = ("occurred_at", "published_at", "created_at")


def _micros(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.unix_micros(F.col(c).cast("timestamp")) if c in df.columns else F.lit(None).cast("bigint"))
    return df


def _payload(df: DataFrame, columns: Iterable[str]) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in columns if c in df.columns]))


def saved(
    items: DataFrame, events: DataFrame | None = None, bridge: DataFrame | None = None, shard: str | None = None,
    judge: Callable[[str, list[str]], int | None] | None = None, summarize: Callable[[str], str | None] | None = None,
    window_hours: int = WINDOW_HOURS, keep_hours: int = GUARD_HOURS, states: bool = True, distinct: bool = False,
) -> DataFrame:
    """(shard, item, outcome, report_id, event): a row per item with its outcome (inserted, deduped, skipped) and event, and a row
    per event that changed, without an item, with the event's last state.

    items: ITEM columns (those missing count as null), arrived_at (the clock; published_at where null) and the shard's column.
    They are taken by arrival, then id. Of items with equal (source_id, external_id) the first counts, the others are skipped;
    what was seen in earlier batches is to be taken out before (duplicates.unseen). events: rows of an events table, bridge:
    (report_id, source_id, external_id, published_at), what earlier batches left; only those within keep_hours before the
    first item, or from what its latest item may ask for on, are read. An event has the id of the item that opened it.
    What is older than keep_hours is let go, other than what follow-ups that arrive later than that ask for: these go through the
    task a first time before all others. Without `states` the events' rows are left out. With `distinct` rows that are equal in
    all columns count once.
    """
    of = F.coalesce(F.col(shard).cast("string"), F.lit("")) if shard else F.lit("")
    # Read once, except where the first item's time is needed before.
    rows = (items if events is None else kept(items)).withColumn("_shard", of).withColumn("_at", F.unix_micros(F.coalesce("arrived_at", "published_at").cast("timestamp")))
    rows = _micros(rows, "published_at")
    keyed = F.col("source_id").isNotNull() & F.col("external_id").isNotNull()
    # Items without a key are each their own group. Those seen before go with the others, but as a mere id: one shuffle does for both.
    group = W.partitionBy("source_id", "external_id", "_own").orderBy(F.col("_at").asc_nulls_first(), "id")
    rows = rows.withColumn("_own", F.when(~keyed, F.col("id")))
    if distinct:  # within the shuffle that the groups need
        rows = rows.repartition("source_id", "external_id", "_own").distinct()
    rows = rows.withColumn("_n", F.row_number().over(group)).withColumn("_first", F.first("id").over(group))
    fresh = ~keyed | (F.col("_n") == 1)
    names = [c for c in ITEM if c in rows.columns and (states or c not in ("source_url", "severity", "status", "media"))]  # those decide on no outcome
    asked = F.col("published_at") - ATTACH_MINUTES * MINUTE
    late = fresh & (asked < F.coalesce("_at", F.lit(0)) - keep_hours * HOUR)
    kind = F.explode(F.when(late, F.array(F.lit(-1), F.lit(2))).when(fresh, F.array(F.lit(2))).otherwise(F.array(F.lit(3))))
    stream = rows.where(fresh | (F.col("id") != F.col("_first"))).select("_shard", kind.alias("kind"), F.coalesce("_at", F.lit(0)).alias("at"), "id", F.lit(None).cast("string").alias("row"), *[F.when(fresh, F.col(c)).alias(c) for c in names if c != "id"])
    if events is not None:
        start, first = rows.where(fresh).agg(F.min("_at"), F.min(F.when(late, asked))).first()
        since = (start or 0) - keep_hours * HOUR
        since = since if first is None else min(since, first)
        e = _micros(events.withColumn("_shard", of if shard and shard in events.columns else F.lit("")), *TIMES).where(F.greatest(F.coalesce("published_at", F.lit(0)), F.coalesce("created_at", F.lit(0))) >= since)
        stream = stream.unionByName(e.select("_shard", F.lit(0).alias("kind"), F.lit(0).alias("at"), "id", _payload(e, [c.split(" ")[0] for c in EVENT.split(", ")]).alias("row")), allowMissingColumns=True)
        if bridge is not None:
            b = _micros(bridge, "published_at").join(e.select(F.col("id").alias("report_id"), "_shard"), "report_id")
            stream = stream.unionByName(b.select("_shard", F.lit(1).alias("kind"), F.lit(0).alias("at"), F.col("report_id").alias("id"), _payload(b, ("source_id", "external_id", "published_at")).alias("row")), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, desk = None, Desk()

        def changed(gone: Iterable[Event]) -> list[tuple]:
            return [(shard, None, None, e.id, _row(e)) for e in gone if e.id in desk.touched] if states else []

        for batch in batches:
            out: list[tuple] = []
            rows = batch.to_pydict()
            for own, kind, at, id_, text, *values in zip(*(rows[c] for c in ("_shard", "kind", "at", "id", "row", *names))):
                if own != shard:
                    out += changed(desk.events.values())
                    shard, desk = own, Desk(judge, summarize, window_hours, keep_hours)
                if kind == -1:
                    desk.ask(dict(zip(names, values)), at)
                elif kind == 0:
                    desk.hold(Event(**{k: v for k, v in json.loads(text).items() if v is not None}))
                elif kind == 1:
                    if id_ in desk.events:
                        row = json.loads(text)
                        desk.events[id_].keys.add(("" if row.get("source_id") is None else row["source_id"], row.get("external_id") or ""))
                        desk.tell(row.get("source_id"), row.get("published_at"), row.get("external_id") or "", id_)
                elif kind == 2:
                    out += changed(desk.forget(at))
                    out.append((shard, id_, *desk.save(dict(zip(names, values)), at), None))
                else:
                    out.append((shard, id_, "skipped", None, None))
            if out:
                yield _batch(out)
        if last := changed(desk.events.values()):
            yield _batch(last)

    return stream.repartition("_shard").sortWithinPartitions("_shard", "kind", "at", "id").mapInArrow(run, _OUT)


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of saved()."""
    event = pa.struct([(c.split(" ")[0], _ARROW[c.split(" ")[1]]) for c in EVENT.split(", ")])
    kinds = dict(shard=pa.string(), item=pa.string(), outcome=pa.string(), report_id=pa.string(), event=event)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def _row(e: Event) -> dict:
    return {c.split(" ")[0]: getattr(e, c.split(" ")[0]) for c in EVENT.split(", ")}


def outcomes(made: DataFrame) -> DataFrame:
    """(item, outcome, report_id) of saved(), a kept table."""
    return made.where("item IS NOT NULL").select("item", "outcome", "report_id")


def changed_events(made: DataFrame) -> DataFrame:
    """The events of saved(), a kept table, as rows of an events table. An event let go of and opened anew has its last state."""
    rows = made.where("item IS NULL").select("event.*", "shard")
    for c in TIMES:
        rows = rows.withColumn(c, F.timestamp_micros(c))
    return rows


def bridge_rows(made: DataFrame, items: DataFrame) -> DataFrame:
    """(report_id, source_id, source_name, source_url, external_id, published_at, excerpt): the message behind every outcome with an event."""
    own = items.select(F.col("id").alias("item"), "source_id", "source_name", *[F.col(c) if c in items.columns else F.lit(None).cast("string").alias(c) for c in ("source_url",)], F.coalesce("external_id", F.lit("")).alias("external_id"), "published_at", F.substring(F.coalesce("content", F.lit("")), 1, EXCERPT_CHARS).alias("excerpt"))
    return outcomes(made).where("report_id IS NOT NULL").select("item", "report_id").join(own, "item").drop("item")

"""Text functions as Columns: cleaning, titles, summaries, time, HTML, replies. Null counts as empty unless stated."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import lexicon as X

SUMMARY_CHARS, TITLE_CHARS, FEED_CHARS = 750, 90, 400
EXCERPT_CHARS, ERROR_CHARS, DETAIL_CHARS = 280, 500, 200
#: What an update's line in an event's content starts with.
UPDATE_PREFIX = re.compile(r"^עדכון \([^)]*\):\s*")


def strip(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(c, f"^{X.WS}+|{X.WS}+$", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{X.WS}+", " "))


@F.pandas_udf(StringType())
def _clean(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield pd.Series([clean_literal(t) if t else "" for t in s], dtype=object)


def clean(c: Column) -> Column:
    """Readable text: NFKC, without unseen characters, points, channel signatures, links and emoji; blanks collapsed.

    One Arrow pass: a signature's pattern is run only on texts that hold its sign, and the second round (links and emoji may
    hide the end of a line from the signatures) only on texts that the first one changed. As JVM expressions all 54
    patterns run on every text, which costs some forty times the CPU (measured).
    """
    return _clean(c)


def matchable(cleaned: Column) -> Column:
    """The form in which words are searched, of a cleaned text: no punctuation, lower case."""
    t = F.regexp_replace(cleaned, r"[\x{5f3}\x{5f4}]", " ")
    t = F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}_\x{{590}}-\x{{5ff}}{X.WS[1:-1]}]", " ")
    return F.lower(collapse(t))


def _own(p: str, flags: int = 0) -> re.Pattern:
    """A pattern of the lexicon in Python's dialect."""
    p = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m.group(1), 16):08x}", p)
    return re.compile(p.replace(r"\p{L}\p{N}_", r"\w").replace(r"\p{Nd}", r"\d"), flags)


_UNSEEN = _own(f"{X.INVISIBLE}|{X.MARKS}".replace("]|[", ""))
_TIME, _LINK = _own(X.INLINE_TIME), _own(X.URL)
#: Emoji below and above U+10000 apart: only a class without the latter is looked up in one table.
_EMOJI = [_own(c) for c in (re.sub(r"\\x\{1f[0-9a-f]{3}\}-\\x\{1f[0-9a-f]{3}\}", "", X.EMOJI), r"[\x{1f000}-\x{1faff}]")]
_SIGNATURES = [(sign, _own(p, re.M)) for p, sign in zip(X.BOILERPLATE, X.SIGNS)]


def _unsigned(t: str) -> str:
    for sign, pattern in _SIGNATURES:
        if sign in t:
            t = pattern.sub("", t)
    return t


def clean_literal(t: str) -> str:
    """clean() of one text."""
    if not t.isascii():
        if not unicodedata.is_normalized("NFKC", t):
            t = unicodedata.normalize("NFKC", t)
        t = _UNSEEN.sub("", t)
    if "(" in t and "/" in t:
        t = _TIME.sub("-", t)
    before = t
    t = _unsigned(t)
    if "http" in t or "t.me/" in t or "www." in t:
        t = _LINK.sub("", t)
    if not t.isascii():
        for emoji in _EMOJI:
            t = emoji.sub(" ", t)
    if t != before:
        t = _unsigned(t)
    return " ".join(t.split())


_NO_WORD = re.compile(r"[^\w\u0590-\u05ff\s]|[\u05f3\u05f4]")


@lru_cache(100_000)
def matchable_literal(text: str) -> str:
    """matchable(clean()) of one text outside a plan: word lists go through the same steps as texts."""
    return " ".join(_NO_WORD.sub(" ", clean_literal(text)).split()).lower()


def title(cleaned: Column, chars: int = TITLE_CHARS) -> Column:
    """The first sentence of a cleaned text, cut at a word with an omission mark if it is too long."""
    first = strip(F.coalesce(F.nullif(F.regexp_extract(cleaned, f"^((?s:.*?)[.!?]){X.WS}", 1), F.lit("")), cleaned))
    return F.when(cleaned == "", F.lit(X.NO_TITLE)).when(F.length(first) > chars, _cut(first, chars)).otherwise(first)


def _cut(t: Column, chars: int) -> Column:
    return F.concat(F.regexp_replace(F.substring(t, 1, chars), "(?s) [^ ]*$", ""), F.lit("…"))


def summary(c: Column, chars: int = SUMMARY_CHARS) -> Column:
    """As many whole sentences as fit; if not even one fits, cut at a word with an omission mark."""
    t = strip(F.coalesce(c, F.lit("")))
    fold = F.aggregate(
        F.split(t, f"(?<=[.!?]){X.WS}+"),
        F.struct(F.lit("").alias("out"), F.lit(False).alias("full")),
        lambda a, s: F.when(a["full"] | (F.length(a["out"]) + F.length(s) + 1 > chars), F.struct(a["out"].alias("out"), F.lit(True).alias("full"))).otherwise(
            F.struct(strip(F.concat(a["out"], F.lit(" "), s)).alias("out"), F.lit(False).alias("full"))
        ),
        lambda a: a["out"],
    )
    return F.when(F.length(t) <= chars, t).otherwise(F.coalesce(F.nullif(fold, F.lit("")), _cut(t, chars)))


def time_of(c: Column) -> Column:
    """A timestamp of ISO text (Z allowed), null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))


def local_time(ts: Column, zone: str = "Asia/Jerusalem") -> Column:
    return F.date_format(F.from_utc_timestamp(ts, zone), "HH:mm:ss")


def without_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def feed_summary(*candidates: Column, chars: int = FEED_CHARS) -> Column:
    """The first candidate with a text, without tags, cleaned, its first characters."""
    some = F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))
    return F.substring(clean(without_tags(some)), 1, chars)


def image_in_html(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"""(?i)<img[^>]+src=["']([^"']+)["']""", 1), F.lit(""))


def first_text(*candidates: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def reply_object(c: Column, schema: str) -> Column:
    """The JSON object in a model's reply: fences aside, the whole text, or else from the first brace to the last."""
    t = strip(F.regexp_replace(strip(c), r"^```(?:json)?|```$", ""))
    whole = F.when(t.rlike(r"^\{"), F.from_json(t, schema, {"mode": "PERMISSIVE"}))
    part = F.nullif(F.regexp_extract(t, r"(?s)\{.*\}", 0), F.lit(""))
    return F.coalesce(whole, F.when(~t.rlike(r"^\{"), F.from_json(part, schema)))


def channel_handle(handle: Column, url: Column) -> Column:
    """The bare name of a channel: of handle, or else of url, without link prefixes, `s/` and `@`, up to a slash or question mark."""
    t = strip(first_text(handle, url))
    t = F.regexp_replace(t, r"^(?:https?://)?(?:www\.)?(?:t\.me|telegram\.me)/", "")
    t = F.regexp_replace(F.regexp_replace(t, "^s/", ""), "^@+", "")
    return F.nullif(strip(F.regexp_extract(t, r"^([^/?]*)", 1)), F.lit(""))


def keyword_list(c: Column) -> Column:
    """Trimmed, non-empty words of a comma-separated text."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda w: w != "")

"""Problem 4: text that looks the same brought to the same characters.

Most text is stable already, so a quick check (one JVM regular expression made of the Unicode quick-check properties)
picks the values that hold an unstable character at all. Only those travel to Python, where each unstable segment - a
word with what is unstable in or beside it - is normalised with its neighbours as context and spliced into the
otherwise untouched text. Unstable are:

* letters and digits that NFKC does not keep (full width, presentation forms, ligatures, letter symbols),
* marks that NFC composes with the letter before them (vowel points are left alone),
* blanks other than the usual one, and characters that cannot be seen (a joiner inside an emoji stays),
* words whose letters come from several of the Latin, Cyrillic and Greek scripts,
* words made only of letters that another script shares. Whether such a word is the usual one is asked of the whole
  corpus: of the forms of one skeleton the most frequent among texts of the same main script is the usual one.

Null stays null, an empty text stays empty; punctuation, emoji, line ends and damage marks are never changed.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept

# Characters that cannot be seen, and blanks other than the usual one (ranges of the Unicode standard).
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0e\ufeff\uffa0\ufff0-\ufffb"
BLANKS = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
# Marks that compose with Latin, Cyrillic, Greek and Arabic letters; letters that NFKC keeps but that look like two.
MARKS = "\u0300-\u036f\u0653-\u0655"
PAIRED = {"װ": "וו", "ױ": "וי", "ײ": "יי"}
# Letters that look alike, position by position.
LATIN = "ABEKMHOPCTXYIJSZNaeocpxyijskhg"
CYRILLIC = "АВЕКМНОРСТХУІЈЅ  аеосрхуіјѕ һ "
GREEK = "ΑΒΕΚΜΗΟΡ ΤΧΥΙ  ΖΝ  ο     ι   "
KINDS_THAT_DIFFER = ("<super>", "<sub>", "<circle>", "<fraction>", "<square>", "<vertical>", "<small>")
# The blocks of the Unicode standard that hold letters and digits with compatible forms.
COMPATIBLE_BLOCKS = ((0x80, 0x3400), (0xA640, 0xAC00), (0xF900, 0x10000), (0x10780, 0x107C0), (0x1D400, 0x1D800), (0x1E030, 0x1E070), (0x1EE00, 0x1EF00), (0x1F100, 0x1F200), (0x1FBF0, 0x1FBFA), (0x2F800, 0x2FA20))
#: Unusual forms that are sent to the tasks as a table; words that a worker remembers before it starts anew.
TABLE_LIMIT, REMEMBERED = 20_000, 500_000


def _ranges(codes: list[int]) -> str:
    out, start = [], codes[0]
    for a, b in zip(codes, codes[1:] + [-1]):
        if b != a + 1:
            out.append(chr(start) if start == a else f"{chr(start)}-{chr(a)}")
            start = b
    return "".join(out)


def _compatible() -> dict[str, str]:
    """Letters and digits whose compatible form looks the same."""
    out = {}
    for code in (c for a, b in COMPATIBLE_BLOCKS for c in range(a, b)):
        c = chr(code)
        if unicodedata.category(c)[0] in "LN" and not unicodedata.is_normalized("NFKC", c) :
            if unicodedata.decomposition(c).split(" ")[0] not in KINDS_THAT_DIFFER:
                out[c] = unicodedata.normalize("NFKC", c)
    return out | PAIRED


COMPATIBLE = _compatible()
_COMPAT_CLASS = _ranges(sorted(map(ord, COMPATIBLE)))
_UNSTABLE = f"{INVISIBLE}{BLANKS}{MARKS}{_COMPAT_CLASS}"
_TO_LATIN = {b: a for row in (CYRILLIC, GREEK) for a, b in zip(LATIN, row) if b != " "}
_TO = {
    "L": _TO_LATIN,
    "C": {a: b for a, b in zip(LATIN, CYRILLIC) if b != " "},
    "G": {a: b for a, b in zip(LATIN, GREEK) if b != " "},
}
for _row, _goal in ((GREEK, "C"), (CYRILLIC, "G")):
    _TO[_goal] |= {g: _TO[_goal][a] for a, g in zip(LATIN, _row) if g != " " and a in _TO[_goal]}
_CLASS = {"L": "A-Za-zÀ-ɏ", "C": "Ѐ-ԯ", "G": "Ͱ-Ͽ"}
_MIXED = "|".join(f"[{_CLASS[a]}][{_CLASS[b]}]" for a in "LCG" for b in "LCG" if a != b)
_ONLY = {k: re.escape("".join(sorted({c for c in row if c != " "}))) for k, row in (("L", "".join(a for a, b, c in zip(LATIN, CYRILLIC, GREEK) if (b + c).strip())), ("C", CYRILLIC), ("G", GREEK))}
# Ranges of characters that are stable in themselves, most texts being made of the first few alone.
PLAIN = "\\x00-\\x7e\u05d0-\u05ea\u0621-\u064a\u0591-\u05c7\u05f3\u05f4" + _ranges([c for c in range(0xC0, 0x250) if chr(c) not in COMPATIBLE]) + "\u2010-\u2027\u2030-\u205e\u2600-\u27bf\ufe0f\U0001f300-\U0001faff"
STABLE = PLAIN + "\u0400-\u052f"
_CROSSING = "[\u0370-\u052f]"
_RUN_CLASS = f"[{_CLASS['L']}\u0370-\u052f{MARKS}]"
_SHARED = "^(?:" + "|".join(f"[{_ONLY[k]}]+" for k in "LCG") + ")$"
_FOREIGN = f"(?<!{_RUN_CLASS})(?:[{_ONLY['C']}]+|[{_ONLY['G']}]+)(?!{_RUN_CLASS})"


def unstable(c: Column, foreign: bool = False) -> Column:
    """The quick check: may hold something that the canonical form changes; words of shared letters only if `foreign`."""
    return c.rlike(f"[^{PLAIN}]") & (c.rlike(f"[^{STABLE}]") | c.rlike(_MIXED) | (c.rlike(_FOREIGN) if foreign else F.lit(False)))


def shared_words(c: Column) -> Column:
    """The distinct words made only of letters that another script shares."""
    return F.array_distinct(F.filter(F.regexp_extract_all(c, F.lit(f"{_RUN_CLASS}+"), F.lit(0)), lambda w: w.rlike(_SHARED)))


def has_foreign_shared(c: Column) -> Column:
    return c.rlike(_CROSSING) & c.rlike(_FOREIGN)


_HIT = re.compile(f"[{_UNSTABLE}]")
# The quick check of a text: classes of characters below U+10000 are looked up in one table, with others among them range by
# range; so the others are asked for apart, by the few blocks that they stand in.
_BLOCKS_ABOVE = "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in COMPATIBLE_BLOCKS if a > 0xFFFF)
_QUICK = re.compile("[" + "".join(c for c in (INVISIBLE, BLANKS, MARKS)) + _ranges(sorted(ord(c) for c in COMPATIBLE if ord(c) < 0x10000)) + "]")
_QUICK_ABOVE = re.compile(f"[{_BLOCKS_ABOVE}]")
_HIT_OR_MIXED = re.compile(f"[{_UNSTABLE}]|{_MIXED}")
_OTHER_SCRIPT = re.compile("[\u0370-\u052f]")
_PART = re.compile(rf"[\w{_UNSTABLE}]")
_RUN = re.compile(f"[{''.join(_CLASS.values())}{MARKS}]+")
_OWN = {k: re.compile(f"[{v}]") for k, v in _CLASS.items()}
_HIDDEN = re.compile(f"[{INVISIBLE}]")
_BLANK = re.compile(f"[{BLANKS}]")
_COMPAT = re.compile(f"[{_COMPAT_CLASS}]")
_MARKED = re.compile(rf"[^\W\d_][{MARKS}]+")
_JOINED = "\u200d"


def _pictorial(c: str) -> bool:
    return c in "\ufe0f\u20e3" or unicodedata.category(c) in ("So", "Sk")


def _one_script(m: re.Match) -> str:
    """The letters of a word taken to the script that most of its letters have, of those that no other script shares if there are any."""
    word = m.group(0)
    count = {k: len(rx.findall(word)) for k, rx in _OWN.items()}
    if sum(bool(n) for n in count.values()) < 2:
        return word
    sure = {k: sum(1 for c in rx.findall(word) if c not in _ONLY[k]) for k, rx in _OWN.items()}
    goal = max("LCG", key=lambda k: (sure[k] > 0, count[k], k == "L"))
    return "".join(_TO[goal].get(c, c) for c in word)


def _composed(segment: str) -> str:
    return _MARKED.sub(lambda m: unicodedata.normalize("NFC", m.group(0)), segment)


def canonical_segment(segment: str, before: str = "", after: str = "") -> str:
    """One unstable segment; `before` and `after` are the characters beside it."""
    def hide(m: re.Match) -> str:
        i, left, right = m.start(), segment[m.start() - 1 : m.start()] or before, segment[m.end() : m.end() + 1] or after
        return _JOINED if segment[i] == _JOINED and left and right and _pictorial(left) and _pictorial(right) else ""

    segment = _HIDDEN.sub(hide, segment)
    segment = _BLANK.sub(" ", segment)
    segment = _COMPAT.sub(lambda m: COMPATIBLE[m.group(0)], segment)
    segment = _composed(segment)
    return _composed(_RUN.sub(_one_script, segment))


def _with_usual(text: str, usual: dict[str, str] | None) -> str:
    """Words of shared letters in their usual form; a text that holds none of the unusual forms is only searched."""
    if not usual or usual.keys().isdisjoint(_RUN.findall(text)):
        return text
    return _RUN.sub(lambda m: usual.get(m.group(0), m.group(0)), text)


@lru_cache(10_000)
def _in_segment(c: str) -> bool:
    return _PART.match(c) is not None


def _spliced(text: str, hits: Iterable[int]) -> str:
    """The text with the segments around these places replaced."""
    out, done = [], 0
    for a in hits:
        if a < done:
            continue
        z = a + 1
        while a > done and _in_segment(text[a - 1]):
            a -= 1
        while z < len(text) and _in_segment(text[z]):
            z += 1
        out += [text[done:a], canonical_segment(text[a:z], text[a - 1 : a], text[z : z + 1])]
        done = z
    return "".join(out) + text[done:]


def canonical_text(text: str | None, usual: dict[str, str] | None = None) -> str | None:
    """The whole text with its unstable segments replaced. `usual` has the usual form of words made of shared letters."""
    if not text:
        return text
    other = _OTHER_SCRIPT.search(text)
    if other or _QUICK.search(text) or _QUICK_ABOVE.search(text):
        text = _spliced(text, (m.start() for m in (_HIT_OR_MIXED if other else _HIT).finditer(text)))
    return _with_usual(text, usual)


_OWN_LETTERS = {"H": "[\u05d0-\u05ea]", "A": "[\u0621-\u064a]", "C": f"(?![{_ONLY['C']}])[\u0400-\u052f]", "G": f"(?![{_ONLY['G']}])[\u0370-\u03ff]"}
_OWN_RX = {k: re.compile(p) for k, p in _OWN_LETTERS.items()}


def main_script(c: Column) -> Column:
    """H, A, C, G or L: the first of these scripts that the text has a letter of which no other script shares; L if none."""
    return F.coalesce(*[F.when(c.rlike(p), F.lit(k)) for k, p in _OWN_LETTERS.items()], F.lit("L"))


def script_of(text: str) -> str:
    """main_script() of one text."""
    return next((k for k, rx in _OWN_RX.items() if rx.search(text)), "L")


# Of each code point below U+10000 whether it is unstable (1), its script among those that may mix (2, 4, 8), whether it is a mark (16).
_SCRIPTS, _LETTERS = 2 + 4 + 8, 2 + 4 + 8 + 16


def _kinds() -> np.ndarray:
    every, out = "".join(map(chr, range(0x10000))), np.zeros(0x10000, np.uint8)
    for bit, rx in ((1, _QUICK), (2, _OWN["L"]), (4, _OWN["C"]), (8, _OWN["G"]), (16, re.compile(f"[{MARKS}]"))):
        out[[m.start() for m in rx.finditer(every)]] |= bit
    return out


_KINDS, _ABOVE = _kinds(), np.array(sorted(ord(c) for c in COMPATIBLE if ord(c) > 0xFFFF), np.uint32)


def canonical_texts(texts: list[str], forms: dict[str, dict[str, str]]) -> list[str]:
    """canonical_text() of each text, with the usual forms of its main script (`forms`).

    Unstable places are looked for in all texts at once, character by character in a table, instead of by searches text by text.
    """
    out, ends = list(texts), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _KINDS[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    kinds[high] = np.isin(codes[high], _ABOVE)
    script = kinds & _SCRIPTS
    hit = (kinds & 1).astype(bool)
    hit[:-1] |= (script[:-1] != script[1:]) & (script[:-1] > 0) & (script[1:] > 0)
    at = np.flatnonzero(hit)
    row = np.searchsorted(ends, at, "right")
    first = np.flatnonzero(np.diff(row, prepend=-1))
    for i, lo, hi in zip(row[first].tolist(), first.tolist(), np.append(first[1:], len(row)).tolist()):
        out[i] = _spliced(texts[i], (at[lo:hi] - (ends[i] - len(texts[i]) - 1)).tolist())
    if forms:
        asking = np.zeros(len(texts), bool)
        asking[row] = True
        asking[np.searchsorted(ends, np.flatnonzero(kinds & _LETTERS), "right")] = True
        for i in np.flatnonzero(asking).tolist():
            out[i] = _with_usual(out[i], forms.get(script_of(texts[i])))
    return out


_SHARED_WORD = re.compile(_SHARED)


def usual_forms(df: DataFrame, columns: list[str]) -> DataFrame:
    """(ctx, form, usual): words of shared letters that are not the usual form of their skeleton, counted over all rows of df.

    Forms of one skeleton compete among texts of one main script. A tie keeps both. One Arrow pass counts in how many texts
    each form stands, at a third of the CPU of the JVM's regular expressions (measured).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, is_shared, known = _RUN.findall, _SHARED_WORD.match, {}
        for batch in batches:
            counts: Counter = Counter()
            for column in batch.columns:
                for text in column.to_pylist():
                    words = runs(text) if text else ()
                    if not words:
                        continue
                    forms = []
                    for w in set(words):
                        shared = known.get(w)
                        if shared is None:
                            if len(known) > REMEMBERED:
                                known.clear()
                            shared = known[w] = bool(is_shared(w))
                        if shared:
                            forms.append(w)
                    if forms:
                        ctx = script_of(text)
                        counts.update([(ctx, w) for w in forms])
            yield pa.record_batch({"ctx": pa.array([k[0] for k in counts], pa.string()), "form": pa.array([k[1] for k in counts], pa.string()), "count": pa.array(list(counts.values()), pa.int64())})

    other, latin = zip(*[(b, a) for b, a in _TO_LATIN.items()])
    every = df.select(*columns).mapInArrow(run, "ctx string, form string, count bigint").groupBy("ctx", "form").agg(F.sum("count").alias("count"))
    every = every.withColumn("skeleton", F.translate("form", "".join(other), "".join(latin)))
    best = every.groupBy("ctx", "skeleton").agg(F.max("count").alias("most"), F.max_by("form", "count").alias("usual"), F.count("*").alias("forms")).where("forms > 1")
    return every.join(best, ["ctx", "skeleton"]).where("form <> usual AND count < most").select("ctx", "form", "usual")


def _canonical_udf(usual: dict[tuple[str, str], str]):
    by_ctx = by_script(usual)

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([canonical_text(t, by_ctx.get(script_of(t)) if by_ctx else None) if t is not None else None for t in texts], dtype=object)

    return run


def bounded(forms: DataFrame) -> dict[tuple[str, str], str] | None:
    """The table of unusual forms as (ctx, form) -> usual, if it has at most TABLE_LIMIT entries."""
    rows = forms.limit(TABLE_LIMIT + 1).collect()
    return {(r.ctx, r.form): r.usual for r in rows} if len(rows) <= TABLE_LIMIT else None


def by_script(usual: dict[tuple[str, str], str]) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for (ctx, form), goal in usual.items():
        out.setdefault(ctx, {})[form] = goal
    return out


def canonical(df: DataFrame, columns: list[str], corpus: DataFrame | None = None) -> DataFrame:
    """df with the columns in one consistent form. `corpus` (df itself if not given) decides on words of shared letters.

    The table of unusual forms is sent to the tasks only up to TABLE_LIMIT entries; beyond it, the forms of each row are
    looked up by a join instead.
    """
    forms = usual_forms(df if corpus is None else corpus, columns)
    usual = bounded(forms)
    if usual is not None:
        run = _canonical_udf(usual)
        for c in columns:
            t = F.col(c)
            df = df.withColumn(c, F.coalesce(run(F.when(unstable(t, foreign=bool(usual)), t)), t))
        return df
    run = _canonical_udf({})
    for c in columns:
        t = F.col(c)
        # Written once: both sides of the join must number the rows alike.
        df = kept(df.withColumn(c, F.coalesce(run(F.when(unstable(t), t)), t)).withColumn("_row", F.monotonically_increasing_id()))
        found = (
            df.where(has_foreign_shared(t))
            .select("_row", main_script(t).alias("ctx"), F.explode(shared_words(t)).alias("form"))
            .join(forms, ["ctx", "form"])
            .groupBy("_row")
            .agg(F.map_from_entries(F.collect_list(F.struct("form", "usual"))).alias("_usual"))
        )
        swap = F.udf(lambda text, usual: canonical_text(text, usual), "string", useArrow=True)
        df = df.join(found, "_row", "left").withColumn(c, F.when(F.col("_usual").isNotNull(), swap(t, F.col("_usual"))).otherwise(t)).drop("_row", "_usual")
    return df


def look_alike_cases(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field) of each value that the canonical form changes, blanks at the ends and line ends aside."""
    made = canonical(df.select(key, *columns, *[F.col(c).alias(f"_was_{c}") for c in columns]), columns)
    changed = F.array_compact(
        F.array(*[F.when(F.regexp_replace(F.col(f"_was_{c}"), r"(?U)^\s+|\s+$|\r", "") != F.regexp_replace(F.col(c), r"(?U)^\s+|\s+$|\r", ""), F.lit(c)) for c in columns])
    )
    return made.select(key, F.explode(changed).alias("field")).distinct()

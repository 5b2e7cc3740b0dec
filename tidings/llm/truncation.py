"""Problem 3: values that stop before their sender's text ended.

What follows the message is taken off first: the lines that the source repeats (problem 2), lines that return all over
the corpus in texts that have little else in common, links, hashtags, emoji and marks of omission or damage. The last three characters
of what is left are the value's final context.

A backward character model of order three - last character, the one before it given the last, the third given both -
is trained twice for each language and column: on the contexts at the texts' ends, and on the contexts inside texts, where
the text continues. All positions of all texts are counted. The log-odds of a context is the difference of its two
log-likelihoods; rare contexts shrink towards none. What the second and third character add counts only as far as it does not hang
on the value itself: it is also reckoned with one and with two ends of that context fewer (a copy may be among the values), and
the smallest counts, none if they differ in sign. Per language and column the log-odds of the values fall into two
clusters, and the threshold is put between them (largest variance between the two sides), the fewer values there are, the
more by those of all languages together. Values below it are cut.

Null and blank values, and values of nothing but lines and marks, are no cases.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .canonical import script_of
from .common import kept
from .lines import Remover, line_key, line_keys, removers_of, without_lines
from .near import _WORD

#: A line of furniture follows another line in at least this share of all reports, and in so many (fewer can't be told from chance).
SHARE, LEAST = 0.001, 3
#: The texts around a line of furniture have on average less than this share of their words in common; copies have more.
ALIKE, SAMPLES = 0.5, 8
#: How much weight the pooled estimate has, for the last character and for those before it; ends left out; bins of the histogram.
WEIGHT, WEIGHT_BEFORE, LEFT_OUT, BINS, BOUND = 20.0, 100.0, 2, 60, 8.0
FURNITURE_LIMIT = 20_000
#: A language's histogram is filled up with the one of all languages together, which weighs as much as so many values.
ENOUGH = 200


def _factors(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return r.integers(0, 2**31, n).astype(np.uint32) * np.uint32(2) + np.uint32(1), r.integers(0, 2**32, n).astype(np.uint32)


def _minima(values: np.ndarray, starts: np.ndarray, a: np.uint32, b: np.uint32) -> np.ndarray:
    """Minwise hash values: the words' hashes are random already, so that an odd factor modulo 2^32 orders them anew."""
    return np.minimum.reduceat(values * a + b, starts)


def returning(keys: DataFrame, share: float = SHARE) -> frozenset[int]:
    """Lines that follow another line in at least `share` of the texts: at most 1 / share times the lines of a text on average.
    keys: (id, keys), one row per text, keys being line keys, null at blank lines."""
    k = F.array_compact("keys")
    total = keys.count()
    follow = keys.select(F.explode(F.array_distinct(F.slice(k, 2, F.greatest(F.size(k) - 1, F.lit(0))))).alias("line"))
    return frozenset(r.line for r in follow.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= max(LEAST, share * total)).select("line").collect())


def furniture(docs: DataFrame, lines: frozenset[int], alike: float = ALIKE) -> DataFrame:
    """(line): those of `lines` whose texts have little in common. docs: (id, text, lines), rows of one id being equal.

    A text's own words are those of its lines that neither its source nor the corpus repeats. How similar the own words of a
    line's texts are on average is the chance that two of them agree in a minwise value, over all pairs of texts and SAMPLES
    values: counts only, and the same at every size. Texts without own words agree: what stands there is the message itself.
    """
    factors = _factors(SAMPLES, 31)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                found, words, starts = [], [], []
                for id_, text, own in zip(*(c.to_pylist() for c in whole.slice(lo, 2000).columns)):
                    parts = [(line_key(x), x) for x in text.split("\n")] if "\n" in text else []
                    parts = [x for x in parts if x[0] is not None]
                    hit = {k for k, _ in parts[1:] if k in lines}
                    if hit:
                        starts.append(len(words))
                        known = lines.union(own) if own else lines
                        words += {zlib.crc32(w.encode()) for k, x in parts if k not in known for w in _WORD.findall(x.lower())} or {0}
                        found.append((id_, hit))
                if found:
                    flat, at = np.array(words, np.uint32), np.array(starts)
                    minima = np.stack([_minima(flat, at, a, b) for a, b in zip(*factors)], axis=1).astype(np.int64)
                    rows = [(k, id_, i) for i, (id_, hit) in enumerate(found) for k in hit]
                    yield pa.record_batch({"line": [r[0] for r in rows], "id": [r[1] for r in rows], "values": pa.array([minima[r[2]] for r in rows], pa.list_(pa.int64()))})

    met = docs.select("id", "text", "lines").mapInArrow(run, "line bigint, id string, values array<bigint>").dropDuplicates(["line", "id"])
    same = met.select("line", F.posexplode("values").alias("i", "v")).groupBy("line", "i", "v").agg(F.count("*").cast("double").alias("n"))
    by = same.groupBy("line", "i").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("agree"), F.sum("n").alias("n"))
    return by.groupBy("line").agg(F.sum("agree").alias("agree"), F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs")).where(F.col("agree") < F.col("pairs") * alike).select("line")


def known_furniture(lines: DataFrame) -> frozenset[int] | None:
    """The lines as a set, if they are at most FURNITURE_LIMIT."""
    known = [r.line for r in lines.limit(FURNITURE_LIMIT + 1).collect()]
    return frozenset(known) if len(known) <= FURNITURE_LIMIT else None


def without_furniture(df: DataFrame, text: str, lines: DataFrame) -> DataFrame:
    """df with `text` less its lines in `lines`, by a join: for more lines than a task should be sent."""
    # Written once: both sides of the join must number the rows alike.
    df = kept(df.withColumn("_n", F.monotonically_increasing_id()).withColumn("_k", line_keys(F.col(text))))
    hit = df.select("_n", F.explode("_k").alias("line")).join(lines, "line").groupBy("_n").agg(F.collect_set("line").alias("_hit"))
    df = df.join(hit, "_n", "left")
    return df.withColumn(text, F.when(F.col("_hit").isNull(), F.col(text)).otherwise(without_lines(F.col(text), F.col("_hit")))).drop("_n", "_k", "_hit")


def _alphabet() -> np.ndarray:
    """Classes of code points below 65,536: letters in lower case and common signs have their own, the rest share by kind."""
    import unicodedata

    kinds = {"L": 1, "M": 2, "N": 3, "P": 4, "S": 5, "Z": 6, "C": 7}
    own = {c: 8 + i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, [*range(0x5D0, 0x5EB), *range(0x621, 0x64B), *range(0x430, 0x450), 0x451])) + " \n.,;:!?\"'()[]-…׳״־–—“”«»؟،؛/%")}
    out = np.zeros(65536, np.uint8)
    for code in range(65536):
        c = chr(code)
        out[code] = own.get(c) or own.get(c.lower()) or kinds[unicodedata.category(c)[0]]
    return out


_CLASSES = _alphabet()
SIZE = 256


# Emoji, blanks, unseen characters and marks of omission or damage that may stand at an end; links and hashtags.
_ENDS = "".join(map(chr, [*range(0x1F000, 0x1FB00), *range(0x2600, 0x27C0), *range(0x2190, 0x2200), *range(0x2B00, 0x2C00), 0xFE0F, 0x20E3, 0x85, 0xA0, 0xAD, 0x1680, *range(0x2000, 0x2010), *range(0x2028, 0x2030), *range(0x205F, 0x2070), 0x3000, 0xFEFF, 0xFFFD, 0x2026])) + " \t\n\x0b\f\r"
_OMITTED = ("[\u2026]", "[...]", "(\u2026)", "(...)")
_LAST = re.compile(r"(?:https?://|www\.)\S+|[#@][^\W][\w\u0300-\u036f\u0591-\u05c7]*")
_DOTS = re.compile(r"\.{2,}$")


def message_of(text: str) -> str:
    """The text without what may follow the end of a message, taken off piece by piece."""
    while True:
        before = len(text)
        text = text.rstrip(_ENDS)
        if text.endswith(_OMITTED):
            text = text[: -3 if text[-2] == "\u2026" else -5]
        elif text.endswith(".."):
            text = _DOTS.sub("", text)
        else:
            at = max(text.rfind(" "), text.rfind("\n"), text.rfind("\t")) + 1
            if at < len(text) and text[at] in "hw#@" and _LAST.fullmatch(text, at):
                text = text[:at]
        if len(text) == before:
            return text


def contexts(df: DataFrame, general: frozenset[int] | None = None) -> DataFrame:
    """Rows with an id: its final context; rows without: how often a context is inside and at the end.

    df: (tbl, id, text, lines); one pass over the texts gives (tbl, id, lang, context, inside, ending). With `general`, the
    lines of a text that are in it or in its `lines` go first, and what may follow a message is taken off; without, that
    has been done.
    """
    everywhere = Remover(general) if general is not None else None
    removers: dict[bytes, Remover] = {}

    def messages(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray]:
        texts = batch.column("text").to_pylist()
        if everywhere is not None:
            for i, remove in enumerate(removers_of(batch.column("lines"), removers)):
                text = everywhere(texts[i])
                texts[i] = message_of(remove(text) if remove else text)
        full = np.array([bool(t) for t in texts])
        return [t for t in texts if t], full

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 4000):
                batch = whole.slice(lo, 4000)
                texts, full = messages(batch)
                if not texts:
                    continue
                ids, tables, langs = batch.column("id").filter(pa.array(full)), batch.column("tbl").filter(pa.array(full)), [script_of(t) for t in texts]
                lengths = np.fromiter(map(len, texts), np.int64, len(texts))
                # Two signs of their own kind before each text: contexts at its start don't reach into the text before.
                codes = np.frombuffer(("\x00\x00" + "\x00\x00".join(texts)).encode("utf-32-le", "replace"), np.uint32)
                c = np.where(codes < 65536, _CLASSES[np.minimum(codes, 65535)], 5).astype(np.int32)
                last = np.cumsum(lengths + 2) - 1
                grams = c[2:] | (c[1:-1] << 8) | (c[:-2] << 16)
                final = grams[last - 2]
                group = tables.to_numpy(zero_copy_only=False).astype(str), np.array(langs)
                yield pa.record_batch({
                    "tbl": tables, "id": ids, "lang": pa.array(langs), "context": pa.array(final),
                    "inside": pa.array(np.zeros(len(texts), np.int64)), "ending": pa.array(np.zeros(len(texts), np.int64)),
                })
                both = np.char.add(group[0], group[1])
                where = np.repeat(np.arange(len(texts)), lengths + 2)[2:]
                inner = np.ones(len(grams), bool)
                inner[last - 2] = False
                inner[np.concatenate([last[:-1] + 1, last[:-1] + 2]) - 2] = False  # the signs between texts
                for g in np.unique(both):
                    rows = np.nonzero(both == g)[0]
                    mine = np.zeros(len(texts), bool)
                    mine[rows] = True
                    a, n = np.unique(grams[inner & mine[where]], return_counts=True)
                    b, m = np.unique(final[rows], return_counts=True)
                    every = np.union1d(a, b)
                    inside, ending = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
                    inside[np.searchsorted(every, a)], ending[np.searchsorted(every, b)] = n, m
                    yield pa.record_batch({
                        "tbl": pa.array([group[0][rows[0]]] * len(every)), "id": pa.nulls(len(every), pa.string()), "lang": pa.array([group[1][rows[0]]] * len(every)),
                        "context": pa.array(every), "inside": pa.array(inside), "ending": pa.array(ending),
                    })

    return df.select("tbl", "id", "text", "lines").mapInArrow(run, "tbl string, id string, lang string, context int, inside bigint, ending bigint")


def log_odds(counts: DataFrame, pairs: tuple[tuple[str, str], ...] = (("2", "1"), ("3", "2"))) -> DataFrame:
    """(tbl, lang, context, odds, ending) of every context seen at an end. counts: (tbl, lang, context, inside, ending).
    pairs: the orders that are used beside the first one."""
    two, one = F.col("context").bitwiseAND(F.lit(0xFFFF)), F.col("context").bitwiseAND(F.lit(0xFF))
    df = counts.withColumn("two", two).withColumn("one", one)
    group = ["tbl", "lang"]
    for name, by in (("3", [*group, "context"]), ("2", [*group, "two"]), ("1", [*group, "one"]), ("0", group)):
        w = W.partitionBy(*by)
        df = df.withColumn(f"i{name}", F.sum("inside").over(w)).withColumn(f"e{name}", F.sum("ending").over(w))

    def share(n: Column, of: Column, pooled: Column, weight: float) -> Column:
        return (n + F.lit(weight) * pooled) / (of + F.lit(weight))

    def more(a: str, b: str, fewer: int) -> Column:
        """What the log-odds gain by one character more, with so many ends of the context left out."""
        end, of = F.greatest(F.col(f"e{a}") - fewer, F.lit(0)), F.greatest(F.col(f"e{b}") - fewer, F.lit(0))
        pooled = F.greatest((F.col(f"i{a}") + end) / F.greatest(F.col(f"i{b}") + of, F.lit(1)), F.lit(1e-7))
        return F.log(share(end, of, pooled, WEIGHT_BEFORE)) - F.log(share(F.col(f"i{a}"), F.col(f"i{b}"), pooled, WEIGHT_BEFORE))

    flat = F.lit(1 / SIZE)
    odds = F.log(share(F.col("e1"), F.col("e0"), flat, WEIGHT)) - F.log(share(F.col("i1"), F.col("i0"), flat, WEIGHT))
    for i, (a, b) in enumerate(pairs):
        for fewer in range(LEFT_OUT + 1):
            df = df.withColumn(f"m{i}_{fewer}", more(a, b, fewer))
        ms = [F.col(f"m{i}_{fewer}") for fewer in range(LEFT_OUT + 1)]
        odds = odds + F.when(F.least(*ms) > 0, F.least(*ms)).when(F.greatest(*ms) < 0, F.greatest(*ms)).otherwise(0.0)
    return df.where("ending > 0").select(*group, "context", "ending", odds.alias("odds"))


def _between(n: np.ndarray) -> int:
    """The bin that parts a histogram with the largest variance between both sides; the middle of equally good ones."""
    x = np.arange(len(n))
    left, mean = np.cumsum(n), np.cumsum(n * x)
    total = left[-1]
    parts = (left > 0) & (left < total)  # counts may be fractions: where one side is empty, rounding must not decide
    v = np.where(parts, (mean[-1] * left / total - mean) ** 2 / np.where(parts, left * (total - left), 1), 0)
    best = np.nonzero(v >= v.max() * (1 - 1e-12))[0]
    return int(round(best.mean()))


def thresholds(odds: DataFrame) -> dict[tuple[str, str], float]:
    """The threshold of each (tbl, lang), from its own histogram plus the pooled one at the weight of ENOUGH values: one rule for
    languages of any size. The histograms are a bounded number of rows whatever the data's size."""
    bins = F.floor((F.greatest(F.least(F.col("odds"), F.lit(BOUND - 1e-6)), F.lit(-BOUND)) + BOUND) * (BINS / (2 * BOUND))).cast("int")
    rows = odds.groupBy("tbl", "lang", bins.alias("bin")).agg(F.sum("ending").alias("n")).collect()
    by: dict[tuple[str, str], np.ndarray] = {}
    for r in rows:
        for k in {(r.tbl, r.lang), (r.tbl, "")}:
            by.setdefault(k, np.zeros(BINS))[r.bin] += r.n
    pooled = {t: n * (ENOUGH / n.sum()) for (t, lang), n in by.items() if not lang}
    return {k: (_between(n + pooled[k[0]]) + 1) * 2 * BOUND / BINS - BOUND for k, n in by.items() if k[1]}


def cut_values(df: DataFrame, general: frozenset[int] | None = None) -> DataFrame:
    """(tbl, id, cut) of each value with a message. df: (tbl, id, text, lines), text not null; general: as for contexts()."""
    seen = kept(contexts(df, general if general is not None else frozenset()))
    counts = seen.where("id IS NULL").groupBy("tbl", "lang", "context").agg(F.sum("inside").alias("inside"), F.sum("ending").alias("ending"))
    odds = kept(log_odds(counts))
    limit = F.coalesce(*[F.when((F.col("tbl") == t) & (F.col("lang") == lang), F.lit(x)) for (t, lang), x in thresholds(odds).items()], F.lit(0.0))
    judged = odds.select("tbl", "lang", "context", (F.col("odds") < limit).alias("cut"))
    return seen.where("id IS NOT NULL").join(judged, ["tbl", "lang", "context"]).select("tbl", "id", "cut").distinct()

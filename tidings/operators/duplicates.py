"""Earlier reports of the same event, and the latest report of a source: chunks of time and as-of joins."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WINDOW_HOURS, TIGHT_MINUTES, ATTACH_MINUTES, THRESHOLD = 6, 90, 15, 0.30
#: Later events of one chunk of time in one task; chunks with more are parted.
HOT = 100_000
#: Cells of the table of later and earlier events that are counted at once.
_CELLS = 1 << 20


def unseen(items: DataFrame, *seen: DataFrame) -> DataFrame:
    """Items whose (source_id, external_id) none of the tables has; of items of one key the one that sorts first by its other
    columns. Null keys never count as seen."""
    known = seen[0].select("source_id", "external_id")
    for s in seen[1:]:
        known = known.unionByName(s.select("source_id", "external_id"))
    fresh = items.join(known.where("source_id IS NOT NULL AND external_id IS NOT NULL").distinct(), ["source_id", "external_id"], "left_anti").select(*items.columns)
    keyed = fresh.where("source_id IS NOT NULL AND external_id IS NOT NULL")
    others = [f.name for f in fresh.schema.fields if f.name not in ("source_id", "external_id") and f.dataType.typeName() not in ("map", "variant")]
    # A window that keeps one row is cut within each task before the exchange, so a message stored a million times is no hot group.
    first = keyed.withColumn("_n", F.row_number().over(W.partitionBy("source_id", "external_id").orderBy(*others or [F.lit(0)]))).where("_n = 1").drop("_n")
    return first.unionByName(fresh.where("source_id IS NULL OR external_id IS NULL"))


def _bucket(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / seconds)


def _counts(local: np.ndarray, code: np.ndarray, low: np.ndarray, high: np.ndarray, keys: np.ndarray, n: int, rows: int, first: int, span: int) -> np.ndarray:
    """How many of its tokens each of `rows` later events shares with each of the `span` events from `first` on. local, code: row
    and token of each entry, low, high: the events that the row may meet; keys: token * n + event of all events, sorted."""
    out = np.zeros(rows * span, np.int64)
    a, b = np.searchsorted(keys, code * n + low), np.searchsorted(keys, code * n + high)
    size = np.maximum(b - a, 0)
    met = np.flatnonzero(size)
    a, size, base = a[met], size[met], local[met] * span - code[met] * n - first
    ends = np.cumsum(size)
    cut = 0
    while cut < len(met):  # bounded: a token that all events have meets all of them
        done = ends[cut - 1] if cut else 0
        to = max(cut + 1, int(np.searchsorted(ends, done + _CELLS, "right")))
        k = size[cut:to]
        at = np.arange(ends[to - 1] - done) + np.repeat(a[cut:to] - (ends[cut:to] - k - done), k)
        out += np.bincount(keys[at] + np.repeat(base[cut:to], k), minlength=rows * span)
        cut = to
    return out.reshape(rows, span)


def _own_entries(code: np.ndarray, row: np.ndarray, places: pa.ListArray, words: pa.Array) -> np.ndarray:
    """Which of the entries (token and event) are tokens of the event's own place."""
    found = pc.index_in(places.flatten(), value_set=words)
    known = found.is_valid().to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(places)), pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False))[known]
    return np.isin(row * len(words) + code, at * len(words) + found.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))


def _met(group: pa.Table, similar: int | None, tight: int | None, threshold: float, pairs: bool, schema: pa.Schema) -> pa.Table:
    """The pairs of one chunk of events, or what they come to for each later event; similar, tight: microseconds of the rules."""
    group = group.sort_by([("t", "ascending"), ("id", "ascending")]).combine_chunks()
    n, t = len(group), group.column("t").to_numpy()
    tokens = group.column("tokens").combine_chunks()
    coded = tokens.flatten().dictionary_encode()
    code, size = coded.indices.to_numpy().astype(np.int64), pc.list_value_length(tokens).to_numpy().astype(np.int64)
    row = np.repeat(np.arange(n), size)
    offset = np.concatenate(([0], np.cumsum(size)))
    keys = np.sort(code * n + row)
    if tight is not None:
        place = pc.fill_null(group.column("place").combine_chunks().dictionary_encode().indices, -1).to_numpy().astype(np.int64)
        own = _own_entries(code, row, group.column("place_tokens").combine_chunks(), coded.dictionary)
        own_keys = np.sort((code * n + row)[own])
    reach = max(x for x in (similar, tight) if x is not None)
    low = np.searchsorted(t, t - reach)
    later = np.flatnonzero(group.column("own").to_numpy(zero_copy_only=False))
    out: list[list[np.ndarray]] = []
    k = 0
    while k < len(later):
        width = later[k] - low[later[k]] + 1
        r = later[k : k + max(1, min(_CELLS // width, max(32, width // 2)))]
        k += len(r)
        first, span = low[r[0]], r[-1] - low[r[0]]
        if not span:
            continue
        entry = np.concatenate([np.arange(offset[i], offset[i + 1]) for i in r])
        local, c = np.repeat(np.arange(len(r)), size[r]), code[entry]
        at = np.arange(first, first + span)
        every = _counts(local, c, low[r][local], r[local], keys, n, len(r), first, span)
        score = every / (size[r][:, None] + size[at][None, :] - every)
        ok = shared = None
        if similar is not None:
            ok = (score >= threshold) & (every > 0)
            if similar < reach:
                ok &= t[at][None, :] >= (t[r] - similar)[:, None]
        if tight is not None:
            # Tokens of the later event's place don't count, or if it has none, those of the earlier one's.
            p, q = place[r][:, None], place[at][None, :]
            shared = every
            mine, theirs = own[entry] & (place[r] >= 0)[local], (place[r] < 0)[local]
            for part, of in ((mine, keys), (theirs, own_keys)):
                if part.any() and len(of):
                    shared = shared - _counts(local[part], c[part], low[r][local[part]], r[local[part]], of, n, len(r), first, span)
            close = (shared >= np.where((p >= 0) | (q >= 0), 1, 2)) & ((p < 0) | (q < 0) | (p == q))
            if tight < reach:
                close &= t[at][None, :] >= (t[r] - tight)[:, None]
            ok = close if ok is None else ok | close
        if pairs:
            i, j = np.nonzero(ok)
            out.append([r[i], at[j], score[i, j] if similar is not None else shared[i, j]])
        else:
            links = ok.sum(1)
            some = np.flatnonzero(links)
            # Events stand by time, then id: the last of the highest is the newest, of those the greatest id.
            best = np.where(ok[some], score[some] if similar is not None else shared[some], -1)[:, ::-1]
            j = best.argmax(1)
            out.append([r[some], at[span - 1 - j], best[np.arange(len(some)), j], links[some]])
    if not out:
        return schema.empty_table()
    i, j, value, *links = (np.concatenate(x) for x in zip(*out))
    ids = group.column("id")
    return pa.Table.from_arrays([ids.take(i), *([] if pairs else [pa.array(links[0])]), ids.take(j), pa.array(value)], schema.names).cast(schema)


def _earlier(events: DataFrame, hours: float | None, minutes: float | None, threshold: float, pairs: bool, hot: int = HOT) -> DataFrame:
    """Earlier events by the rule of similarity (hours), by that of closeness (minutes), or by either.

    Events are parted by time, in chunks of twice the longest window; an event also goes to the next chunk if one there may
    reach it. A chunk's pairs are counted within its task over an index of tokens and only rows of the result leave it, so
    what is shuffled is in proportion to the events, not to their pairs. Later events of a chunk with more than `hot` of them
    are dealt to several tasks by id."""
    windows = [None if x is None else round(x * 1_000_000) for x in (hours and hours * 3600, minutes and minutes * 60)]
    reach = max(1, math.ceil(max(x for x in windows if x is not None) / 1_000_000))
    placed = [] if minutes is None else [F.nullif(F.col("place"), F.lit("")).alias("place"), F.coalesce("place_tokens", F.array().cast("array<string>")).alias("place_tokens")]
    e = events.where("id IS NOT NULL AND ts IS NOT NULL AND size(tokens) > 0")
    counts = e.groupBy(_bucket(F.col("ts"), 2 * reach).alias("c")).count().where(F.col("count") > hot).collect()  # chunks, few rows
    second = F.unix_timestamp("ts")
    rows = e.select("id", "ts", F.unix_micros("ts").alias("t"), "tokens", *placed, F.floor(second / (2 * reach)).alias("b"), F.explode(F.sequence(F.floor(second / (2 * reach)), F.floor((second + reach) / (2 * reach)))).alias("c"))
    if counts:
        parts = F.coalesce(F.create_map(*[F.lit(x) for r in counts for x in (r["c"], -(-r["count"] // hot))])[F.col("c")], F.lit(1))
        rows = rows.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
        rows = rows.withColumn("own", (F.col("b") == F.col("c")) & (F.pmod(F.xxhash64("id"), F.col("parts")) == F.col("part"))).drop("parts")
    else:
        rows = rows.withColumn("part", F.lit(0)).withColumn("own", F.col("b") == F.col("c"))
    kind = events.schema["id"].dataType
    value = ("score", T.DoubleType()) if hours is not None else ("shared", T.LongType())
    names = [("id", kind), ("other", kind), value] if pairs else [("id", kind), ("links", T.LongType()), ("best", kind), value]
    made = T.StructType([T.StructField(*x) for x in names])

    def run(group: pa.Table) -> pa.Table:
        return _met(group, *windows, threshold, pairs, to_arrow_schema(made))

    return rows.drop("b", "ts").groupBy("c", "part").applyInArrow(run, made)


def similar_earlier(events: DataFrame, hours: int = WINDOW_HOURS, threshold: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """(id, other, score): each earlier event of the window whose tokens are as similar as the threshold.

    events: (id, ts, tokens), distinct ids, tokens a set. Equal times are ordered by id.
    """
    return _earlier(events, hours, None, threshold, True, hot)


def tight_earlier(events: DataFrame, minutes: int = TIGHT_MINUTES, hot: int = HOT) -> DataFrame:
    """(id, other, shared): earlier events close in time, of no other place, that share tokens beside those of the place.

    events: (id, ts, tokens, place, place_tokens). One shared token is enough if either names a place, else two.
    """
    return _earlier(events, None, minutes, THRESHOLD, True, hot)


def eligible_earlier(events: DataFrame, hours: int = WINDOW_HOURS, minutes: int = TIGHT_MINUTES, threshold: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """(id, other, score): the earlier events that an event may repeat: similar enough within hours, or else close in time with
    tokens in common (as of tight_earlier); score is the Jaccard of the tokens. events: as for tight_earlier."""
    return _earlier(events, hours, minutes, threshold, True, hot)


def best_similar(events: DataFrame, hours: int = WINDOW_HOURS, threshold: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """best_earlier(events, similar_earlier(events)), without the pairs: they grow with the square of the events."""
    return _earlier(events, hours, None, threshold, False, hot)


def best_eligible(events: DataFrame, hours: int = WINDOW_HOURS, minutes: int = TIGHT_MINUTES, threshold: float = THRESHOLD, hot: int = HOT) -> DataFrame:
    """best_earlier(events, eligible_earlier(events)), without the pairs."""
    return _earlier(events, hours, minutes, threshold, False, hot)


def tight_links(events: DataFrame, minutes: int = TIGHT_MINUTES, hot: int = HOT) -> DataFrame:
    """(id, links, shared): the number of each event's tight_earlier() and the most tokens shared with one, without the pairs."""
    return _earlier(events, None, minutes, THRESHOLD, False, hot).drop("best")


def best_earlier(events: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, links, best, score): of each event with partners, their number and the best: highest score, then newest, then greatest id."""
    times = events.select(F.col("id").alias("other"), F.col("ts").alias("other_ts"))
    return pairs.join(times, "other").groupBy("id").agg(F.count("*").alias("links"), F.max(F.struct("score", "other_ts", "other")).alias("m")).select("id", "links", F.col("m.other").alias("best"), F.col("m.score").alias("score"))


def latest_before(probes: DataFrame, events: DataFrame, minutes: int = ATTACH_MINUTES) -> DataFrame:
    """(id, found, found_at): backward as-of join: of each probe (id, source_id, ts) the latest event (event_id, source_id, ts)
    of its source not later and within the tolerance, both ends included. Ties in time go to the greatest event_id.

    Both sides are sorted once by source and time, in time buckets as long as the tolerance (events stand in their own and in the
    next one), so a source with a third of the rows is spread over its buckets and no probe meets more than one event."""
    s = minutes * 60
    p = probes.where("source_id IS NOT NULL AND ts IS NOT NULL").select("source_id", _bucket(F.col("ts"), s).alias("b"), "ts", F.lit(1).alias("kind"), "id", F.lit(None).cast(events.schema["event_id"].dataType).alias("event_id"))
    e = events.where("source_id IS NOT NULL AND ts IS NOT NULL").select("source_id", F.explode(F.array(_bucket(F.col("ts"), s), _bucket(F.col("ts"), s) + 1)).alias("b"), "ts", F.lit(0).alias("kind"), F.lit(None).cast(probes.schema["id"].dataType).alias("id"), "event_id")
    upto = W.partitionBy("source_id", "b").orderBy("ts", "kind", F.col("event_id").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == 0, F.struct("event_id", F.col("ts").alias("at"))), ignorenulls=True).over(upto)
    met = p.unionByName(e).withColumn("m", last).where("kind = 1 AND m IS NOT NULL")
    return met.where(F.unix_micros("ts") - F.unix_micros("m.at") <= s * 1_000_000).select("id", F.col("m.event_id").alias("found"), F.col("m.at").alias("found_at"))


def latest_report(probes: DataFrame, bridge: DataFrame, reports: DataFrame, minutes: int = ATTACH_MINUTES) -> DataFrame:
    """(id, report_id, told_at): the report that a probe's (id, source_id, ts) source told of last, by the bridge (report_id,
    source_id, published_at), if `reports` (id, created_at) still has it; for a probe without a source the report made last."""
    own = latest_before(probes, bridge.select(F.col("report_id").alias("event_id"), "source_id", F.col("published_at").alias("ts")), minutes)
    rest = probes.where("source_id IS NULL").withColumn("source_id", F.lit(""))
    made = latest_before(rest, reports.select(F.col("id").alias("event_id"), F.lit("").alias("source_id"), F.col("created_at").alias("ts")), minutes)
    known = reports.select(F.col("id").alias("found")).distinct()
    return own.unionByName(made).join(known, "found").select("id", F.col("found").alias("report_id"), F.col("found_at").alias("told_at"))

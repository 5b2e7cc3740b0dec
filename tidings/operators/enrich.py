"""From a raw text to an item: title, content, severity, place, blocking key, language."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens as K
from .places import located
from .severity import severity

JUDGE_MINUTES, JUDGE_CANDIDATES = 20, 6


def language(cleaned: Column) -> Column:
    """he if there is any Hebrew character, else other."""
    return F.when(cleaned.rlike(r"[\x{590}-\x{5ff}]"), F.lit("he")).otherwise(F.lit("other"))


def enriched(df: DataFrame, key: str, text: str, terms: DataFrame, default: Column | str = "low") -> DataFrame:
    """df with content, title, severity, location_name, latitude, longitude, dedup_key, lang. `key` is unique; `terms` is a gazetteer."""
    out = df.withColumn("content", T.clean(F.col(text))).withColumn("_m", T.matchable(F.col("content"))).withColumn("_t", K.token_set(F.col("_m")))
    at = located(out, key, "_m", terms).withColumnsRenamed({"name": "location_name", key: "_k"})
    out = out.join(at, F.col(key) == F.col("_k"), "left").drop("_k")
    return out.select(
        *df.columns, "content", T.title(F.col("content")).alias("title"), severity(F.col("_m"), default).alias("severity"), "location_name", "latitude", "longitude",
        K.blocking_key(F.col("content"), F.col("_t"), F.col("location_name")).alias("dedup_key"), language(F.col("content")).alias("lang"),
    )


def judged_same(items: DataFrame, events: DataFrame, judge: Callable[[str, list[str]], int | None]) -> DataFrame:
    """(id, other): for items without a match, the candidate that a judge takes for the same event, if it is plausible.

    items, events: (id, ts, content, place, tokens). Candidates are the newest events within minutes of the item, six at
    most. judge(content, candidates) gives an index or None; an index outside the list is None. Plausible is the same
    place, any shared token, or no place on either side.
    """
    # Candidates are the last events not later than the item's time and the window. Both sides are sorted once by time, in buckets
    # twice as long as the window, which numbers the events; an item then meets just those with the last numbers it can see.
    window = JUDGE_MINUTES * 60_000_000
    bucket = lambda micros: F.floor(micros / (2 * window))
    e = events.where("ts IS NOT NULL").select(F.unix_micros("ts").alias("u"), F.col("id").alias("other"))
    e = e.select(F.explode(F.array(bucket(F.col("u")), bucket(F.col("u")) + 1)).alias("b"), "u", F.lit(0).alias("kind"), "other")
    i = items.where("ts IS NOT NULL").select((F.unix_micros("ts") + window).alias("u"), F.col("id").alias("other"))
    order = W.partitionBy("b").orderBy("u", "kind", "other").rowsBetween(W.unboundedPreceding, 0)
    row = e.unionByName(i.select(bucket(F.col("u")).alias("b"), "u", F.lit(1).alias("kind"), "other")).withColumn("n", F.sum(1 - F.col("kind")).over(order))
    # One more than the limit, as the item itself may be among them.
    asked = row.where("kind = 1").select("b", F.col("other").alias("id"), F.col("u").alias("until"), F.explode(F.sequence(F.col("n"), F.col("n") - JUDGE_CANDIDATES, F.lit(-1))).alias("n"))
    near = asked.join(row.where("kind = 0").select("b", "n", "u", "other"), ["b", "n"]).where((F.col("until") - F.col("u") <= 2 * window) & (F.col("id") != F.col("other")))
    seen = near.withColumn("n", F.row_number().over(W.partitionBy("id").orderBy(F.desc("u"), F.desc("other")))).where(F.col("n") <= JUDGE_CANDIDATES).select("id", "other", "n")
    e = events.select(F.col("id").alias("other"), F.col("content").alias("c2"), F.col("place").alias("p2"), F.col("tokens").alias("k2"))
    top = seen.join(items, "id").join(e, "other")
    plausible = F.coalesce((F.col("place") == F.col("p2")), F.lit(False)) | F.arrays_overlap("tokens", "k2") | (F.col("place").isNull() & F.col("p2").isNull())
    listed = top.groupBy("id").agg(F.first("content").alias("content"), F.array_sort(F.collect_list(F.struct("n", "other", F.coalesce("c2", F.lit("")).alias("c2"), F.coalesce(plausible, F.lit(False)).alias("ok")))).alias("list"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                i = judge(r.content or "", [x["c2"] for x in r.list])
                if i is not None and 0 <= i < len(r.list) and r.list[i]["ok"]:
                    rows.append((r.id, r.list[i]["other"]))
            yield pd.DataFrame(rows, columns=["id", "other"])

    return listed.mapInPandas(run, "id string, other string")

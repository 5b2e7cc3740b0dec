"""Problem 8: sources mixed to target shares of all tokens.

A mix is as large as its sources allow: the scale is the largest at which no source needs more than max_repeats copies of
its documents, so every source that has tokens reaches its share of what is available. (Shares of sources without any
document stay unreached and the others keep their proportions; both show in the report.) Each document of a source then
has the same fractional number of copies c = target tokens / tokens of the source; floor(c) copies are certain, and the
fraction is rounded by pivotal dependent rounding: two documents' probabilities are paired and mass is transferred, at
random but keeping both expectations and the sum of tokens, until one of the two is 0 or 1. So a source's tokens come out
exact but for one residual document; what that would have brought is given to the document nearest to it in size.

Pairing runs within salted buckets (no source, however large, is ever in one task), each leaving at most one residual;
residuals are combined by a reduction tree of fixed fan-in. Randomness comes from a hash of seed, mix and document.

Documents without tokens (null or empty text) are in no mix. A max_repeats of null or below 0 counts as 0. A mix whose
sources have no tokens gives no rows in the selection and shares of 0 in the report.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

#: Documents of a bucket on average; how many buckets' residuals one step of the tree combines.
BUCKET, FAN_IN = 5_000, 64


def pivotal(p: np.ndarray, weight: np.ndarray, chance: np.ndarray, left: float = 1e-9) -> np.ndarray:
    """Probabilities rounded pairwise; at most one stays fractional.

    Of the pair (i, j) either weight moves from j to i until i is 1 or j is 0, or the other way round; the odds keep the
    expectation of both, the amounts keep the sum of weight times probability.
    """
    p = p.copy()
    i = -1
    for j in range(len(p)):
        if p[j] <= left or p[j] >= 1 - left:
            p[j] = round(p[j])
            continue
        if i < 0:
            i = j
            continue
        a, b = weight[i], weight[j]
        up = min((1 - p[i]) * a, p[j] * b)  # tokens that i may gain from j
        down = min(p[i] * a, (1 - p[j]) * b)
        move = up if chance[j] * (up + down) < down else -down
        p[i] += move / a
        p[j] -= move / b
        open_i = left < p[i] < 1 - left
        open_j = left < p[j] < 1 - left
        for k, still in ((i, open_i), (j, open_j)):
            if not still:
                p[k] = round(p[k])
        i = i if open_i else j if open_j else -1
    return p


def scales(targets: DataFrame, tokens: DataFrame) -> DataFrame:
    """(mix, source, target_share, max_repeats, source_tokens, documents, copies): copies is each document's fractional number of copies.

    targets: (mix, source, target_share, max_repeats); tokens: (source, source_tokens, documents).
    """
    t = targets.groupBy("mix", "source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    t = t.withColumn("max_repeats", F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).join(tokens, "source", "left").na.fill(0, ["source_tokens", "documents"])
    can = F.when((F.col("target_share") > 0) & (F.col("source_tokens") > 0) & (F.col("max_repeats") > 0), F.col("max_repeats") * F.col("source_tokens") / F.col("target_share"))
    size = t.groupBy("mix").agg(F.min(can).alias("size"))
    want = F.when((F.col("source_tokens") > 0) & (F.col("max_repeats") > 0), F.col("size") * F.col("target_share") / F.col("source_tokens"))
    return t.join(size, "mix").withColumn("copies", F.coalesce(F.least(want, F.col("max_repeats").cast("double")), F.lit(0.0))).drop("size")


def _round_groups(df: DataFrame, by: list[str], seed: int) -> DataFrame:
    """Pivotal rounding within each group; p is 0, 1 or, of at most one row of a group, fractional."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chance", kind="stable")
        pdf["p"] = pivotal(pdf.p.to_numpy(float), pdf.tokens.to_numpy(float), pdf.chance.to_numpy(float))
        return pdf

    drawn = df.withColumn("chance", F.pmod(F.xxhash64(F.lit(seed), "mix", "doc_id"), F.lit(1 << 52)) / float(1 << 52))
    return drawn.groupBy(*by).applyInPandas(run, drawn.schema).drop("chance")


def select_documents(docs: DataFrame, plan: DataFrame, seed: int = 7, bucket: int = BUCKET, fan_in: int = FAN_IN) -> DataFrame:
    """(mix, source, doc_id, tokens, repeats) of each chosen document. docs: (doc_id, source, tokens), plan: from scales()."""
    rows = docs.where("tokens > 0").join(plan.where("copies > 0").select("mix", "source", "copies", "documents"), "source")
    rows = rows.withColumn("certain", F.floor("copies")).withColumn("p", F.col("copies") - F.col("certain"))
    rows = rows.withColumn("buckets", F.greatest(F.ceil(F.col("documents") / bucket), F.lit(1)))
    rows = rows.withColumn("b", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("buckets"))).drop("documents", "copies", "buckets")
    columns = ["mix", "source", "doc_id", "tokens", "certain"]
    plain = rows.where("p < 1e-9 OR p > 1 - 1e-9").select(*columns, F.round("p").alias("p"))
    step = kept(_round_groups(rows.where("p BETWEEN 1e-9 AND 1 - 1e-9").select(*columns, "p", "b"), ["mix", "source", "b"], seed))
    done = [plain, step.where("p IN (0, 1)").select(*columns, "p")]
    rest = step.where("p NOT IN (0, 1)")
    # At most one row of each bucket is left: the tree's depth is the logarithm of the number of buckets.
    most = plan.agg(F.max(F.ceil(F.col("documents") / bucket))).first()[0] or 1
    level = 1
    while most > 1:
        rest = rest.withColumn("b", F.floor(F.col("b") / fan_in))
        step = kept(_round_groups(rest, ["mix", "source", "b"], seed + 10 * level))
        done.append(step.where("p IN (0, 1)").select(*columns, "p"))
        rest = step.where("p NOT IN (0, 1)")
        most, level = -(-most // fan_in), level + 1
    rest = kept(rest)
    every = rest.select(*columns, F.lit(0.0).alias("p"))
    for part in done:
        every = every.unionByName(part)
    every = every.withColumn("repeats", (F.col("certain") + F.col("p")).cast("int"))
    # What the last residual of a source lacks goes to the document nearest in size that may be repeated once more.
    lack = kept(rest.groupBy("mix", "source").agg(F.sum(F.col("p") * F.col("tokens")).alias("lack")))
    room = every.join(lack, ["mix", "source"]).join(plan.select("mix", "source", "max_repeats"), ["mix", "source"]).where("repeats < max_repeats AND abs(tokens - lack) < lack")
    extra = room.groupBy("mix", "source").agg(F.min_by("doc_id", F.struct(F.abs(F.col("tokens") - F.col("lack")), F.col("doc_id"))).alias("doc_id")).withColumn("more", F.lit(1))
    made = every.join(kept(extra), ["mix", "source", "doc_id"], "left").withColumn("repeats", F.col("repeats") + F.coalesce("more", F.lit(0)))
    return made.where("repeats > 0").select("mix", "source", "doc_id", "tokens", "repeats")


def reached(chosen: DataFrame, plan: DataFrame) -> DataFrame:
    """(mix, source, target_share, share, tokens, documents, most_repeats): what each source of each mix came to."""
    got = chosen.groupBy("mix", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("chosen"), F.max("repeats").alias("most_repeats"))
    both = plan.select("mix", "source", "target_share").join(got, ["mix", "source"], "left").na.fill(0, ["tokens", "chosen", "most_repeats"])
    total = both.groupBy("mix").agg(F.sum("tokens").alias("all"))
    return both.join(total, "mix").select("mix", "source", "target_share", F.when(F.col("all") > 0, F.col("tokens") / F.col("all")).otherwise(0.0).alias("share"), "tokens", F.col("chosen").alias("documents"), "most_repeats")

"""Problem 9: statistics of each document's text, and whether it is prose, a list, a table or junk.

The statistics are standardized over all documents and a Gaussian mixture with diagonal covariances is fitted to them by
expectation-maximization. Every pass runs over all documents; what comes back to the driver is one sum per component and
statistic. The start is taken from hand-labelled examples, of which at most LABELLED are fetched (the smallest doc_ids, a
documented bound for the classifier only); after the last pass each component is mapped to the kind that most of the
examples it explains have, so single wrong labels don't matter. A document gets the kind of most of its responsibility.

Common words are those in at least COMMON of the documents of a script; as a document has so many distinct words on
average, there are at most that average / COMMON of them, whatever the number of documents.

Null, empty and blank texts have a word count of 0, no other statistic and no kind.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .canonical import main_script
from .common import kept

COMMON, LABELLED, PASSES, FLOOR, SAME_LIKELIHOOD = 0.02, 5_000, 25, 0.02, 1e-3
KINDS = ("prose", "list", "table", "junk")
#: Components that each kind starts with.
COMPONENTS = {"prose": 6, "list": 6, "table": 5, "junk": 9}
STATISTICS = ("ended", "common", "digits", "symbols", "word_length", "sentence_words", "commas", "short_lines", "repeated", "links", "odd_letters")
_WORD = re.compile(r"[^\W\d_]+")
_LINK = re.compile(r"(?:https?://|www\.)\S+|[#@][^\W_][\w]*")
_ENDED = re.compile(r"[.!?…؟]['\"״”»)\]]*$")
_SENTENCE = re.compile(r"[.!?…؟\n]+")
_DIGIT, _SYMBOL, _ODD, _COMMA = re.compile(r"\d"), re.compile(r"[^\w\s]|_"), re.compile(r"[\x7f-\xff]"), re.compile(r"[,;|\t،؛]")


def statistics(text: str, common: frozenset[str] | set[str]) -> tuple[int, float, float, float, list[float]]:
    """(words, mean word length, symbol ratio, share of lines ended, [STATISTICS]) of a text that is not blank."""
    size = max(1, len(text) - text.count(" ") - text.count("\n"))
    words = _WORD.findall(text)
    n = len(words)
    ended = ended_chars = short = all_chars = lines = 0
    for line in text.split("\n"):
        line = line.strip()
        if not line:
            continue
        lines += 1
        all_chars += len(line)
        if _ENDED.search(line):
            ended += 1
            ended_chars += len(line)
        elif len(_WORD.findall(line)) <= 4:
            short += len(line)
    lower = text.lower()
    low = _WORD.findall(lower)
    triples = len(low) - 2
    repeated = 1 - len(set(zip(low, low[1:], low[2:]))) / triples if triples > 0 else 0.0
    length = sum(map(len, words)) / n if n else 0.0
    symbols = len(_SYMBOL.findall(text)) / size
    sentences = sum(1 for s in _SENTENCE.split(text) if _WORD.search(s))
    values = [
        ended_chars / max(1, all_chars),
        sum(w in common for w in low) / n if n else 0.0,
        len(_DIGIT.findall(text)) / size,
        symbols,
        float(np.log1p(min(length, 60))),
        float(np.log1p(min(n / sentences if sentences else 0.0, 200))),
        min(len(_COMMA.findall(text)) / max(1, n), 2.0),
        short / max(1, all_chars),
        repeated,
        sum(map(len, _LINK.findall(text))) / size,
        len(_ODD.findall(text)) / size,
    ]
    return n, length, symbols, ended / max(1, lines), values


def common_words(docs: DataFrame, share: float = COMMON) -> dict[str, set[str]]:
    """The common words of each script. docs: (text, script), texts not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for text, script in zip(batch.column("text").to_pylist(), batch.column("script").to_pylist()):
                own = seen.setdefault(script, Counter())
                own.update(set(_WORD.findall(text.lower())))
                own[""] += 1
            for script, own in seen.items():
                yield pa.record_batch({"script": pa.array([script] * len(own)), "word": pa.array(list(own)), "docs": pa.array(list(own.values()), pa.int64())})

    counts = docs.select("text", "script").mapInArrow(run, "script string, word string, docs bigint").groupBy("script", "word").agg(F.sum("docs").alias("docs"))
    # The empty word stands for the number of documents of the script.
    counts = kept(counts)
    total = {r.script: r.docs for r in counts.where("word = ''").collect()}
    least = F.coalesce(*[F.when(F.col("script") == s, F.lit(max(2.0, n * share))) for s, n in total.items()], F.lit(2.0))
    out: dict[str, set[str]] = {s: set() for s in total}
    for r in counts.where((F.col("word") != "") & (F.col("docs") >= least)).select("script", "word").collect():
        out[r.script].add(r.word)
    return out


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, words, word_length, symbol_ratio, lines_ended, common_share, f): the statistics of each document.

    docs: (doc_id, text). f is the array of STATISTICS, null for blank texts.
    """
    blank = ~F.coalesce(F.col("text").rlike(r"(?U)\S"), F.lit(False))
    # A text's script is the first of Hebrew, Arabic, Cyrillic and others that it holds, so rare scripts have common words, too.
    full = docs.select("doc_id", "text").where(~blank).withColumn("script", main_script(F.col("text")))
    common = set().union(*common_words(full).values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                rows = [statistics(t, common) for t in batch.column("text").to_pylist()]
                flat = np.array([r[4] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), *[pa.array([r[i] for r in rows], pa.float64()) for i in (1, 2, 3)], pa.array(flat[:, 1]),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))],
                    names=["doc_id", "words", "word_length", "symbol_ratio", "lines_ended", "common_share", "f"],
                )

    schema = "doc_id bigint, words bigint, word_length double, symbol_ratio double, lines_ended double, common_share double, f array<double>"
    none = docs.where(blank).select("doc_id", F.lit(0).cast("bigint").alias("words"), *[F.lit(None).cast("double").alias(c) for c in ("word_length", "symbol_ratio", "lines_ended", "common_share")], F.lit(None).cast("array<double>").alias("f"))
    return full.mapInArrow(run, schema).unionByName(none)


class Mixture:
    """Diagonal Gaussian mixture on standardized statistics; kinds has, per component, the weight of each kind."""

    def __init__(self, mean, scale, weights, means, variances, kinds=None):
        self.mean, self.scale, self.weights, self.means, self.variances, self.kinds = mean, scale, weights, means, variances, kinds

    def responsibilities(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(standardized rows, responsibilities, log-likelihoods)."""
        z = np.clip((f - self.mean) / self.scale, -8, 8)
        inv = 1 / self.variances
        log = -0.5 * ((z**2) @ inv.T - 2 * z @ (self.means * inv).T + (self.means**2 * inv).sum(1)) - 0.5 * np.log(self.variances).sum(1) + np.log(self.weights)
        top = log.max(1, keepdims=True)
        r = np.exp(log - top)
        total = r.sum(1, keepdims=True)
        return z, r / total, (top + np.log(total))[:, 0]


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    f = batch.column("f")
    start, end = f.offsets[0].as_py(), f.offsets[len(f)].as_py()
    return f.values.to_numpy()[start:end].reshape(len(f), -1)


def _one_pass(features: DataFrame, model: Mixture) -> tuple[np.ndarray, float, int]:
    """Sums of every component: rows, statistics, squares; the log-likelihood and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, fit, n = 0.0, 0.0, 0
        for batch in batches:
            if batch.num_rows:
                z, r, log = model.responsibilities(_rows(batch))
                sums, fit, n = sums + np.concatenate([r.sum(0)[:, None], r.T @ z, r.T @ z**2], axis=1), fit + log.sum(), n + len(z)
        if n:
            flat = np.concatenate([sums.ravel(), [fit, n]])
            yield pa.record_batch({"i": np.arange(len(flat), dtype=np.int32), "x": flat})

    rows = features.select("f").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(len(rows))
    for r in rows:
        flat[r.i] = r.x
    return flat[:-2].reshape(len(model.weights), -1), flat[-2], int(flat[-1])


def _seeds(z: np.ndarray, k: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Centres of k groups of the rows (farthest-first start, then a few steps of k-means), and the groups' sizes."""
    rng = np.random.default_rng(seed)
    k = min(k, len(z))
    centres = z[[0]]
    for _ in range(k - 1):
        d = ((z[:, None] - centres) ** 2).sum(2).min(1)
        centres = np.vstack([centres, z[rng.choice(len(z), p=d / d.sum()) if d.sum() else 0]])
    for _ in range(10):
        own = ((z[:, None] - centres) ** 2).sum(2).argmin(1)
        centres = np.array([z[own == j].mean(0) if (own == j).any() else centres[j] for j in range(k)])
    return centres, np.array([(own == j).sum() for j in range(k)])


def examples(features: DataFrame, labels: DataFrame, most: int = LABELLED) -> list[Row]:
    """(f, label) of the labelled documents: a document counts once for each label it has."""
    marks = labels.select("doc_id", "label").where(F.col("label").isin(*KINDS)).distinct().orderBy("doc_id", "label").limit(most)
    return features.join(F.broadcast(marks), "doc_id").orderBy("doc_id", "label").select("f", "label").collect()  # at most `most` rows


def fitted(features: DataFrame, labelled: list[Row], passes: int = PASSES) -> Mixture | None:
    """The mixture, fitted to all rows of features (doc_id, f), a kept table; None if there are no examples or no documents."""
    d = len(STATISTICS)
    stats = features.agg(*[F.avg(F.get("f", F.lit(i))).alias(f"m{i}") for i in range(d)], *[F.stddev_pop(F.get("f", F.lit(i))).alias(f"s{i}") for i in range(d)]).first()
    if not labelled or stats["m0"] is None:
        return None
    mean, scale = np.array([stats[f"m{i}"] for i in range(d)]), np.array([max(stats[f"s{i}"], 1e-3) for i in range(d)])
    f, label = np.array([r.f for r in labelled]), np.array([r.label for r in labelled])
    z = np.clip((f - mean) / scale, -8, 8)
    centres, sizes = zip(*[_seeds(z[label == kind], COMPONENTS[kind]) for kind in KINDS if (label == kind).any()])
    means, weights = np.vstack(centres), np.concatenate(sizes).astype(float)
    model = Mixture(mean, scale, weights / weights.sum(), means, np.full(means.shape, 0.5))
    before = -np.inf
    for _ in range(passes):
        sums, fit, n = _one_pass(features, model)
        rows = np.maximum(sums[:, :1], 1e-9)
        means = sums[:, 1 : d + 1] / rows
        variances = np.maximum(sums[:, d + 1 :] / rows - means**2, FLOOR)
        model = Mixture(mean, scale, np.maximum(sums[:, 0] / n, 1e-9), means, variances)
        if fit / n - before < SAME_LIKELIHOOD:
            break
        before = fit / n
    _, r, _ = model.responsibilities(f)
    # A kind's say in a component: its share of the examples the component explains, and a trifle of all for components without examples.
    say = np.array([[r[label == kind, k].sum() for kind in KINDS] for k in range(len(weights))])
    model.kinds = say + 0.01 * say.sum(0) / say.sum()
    return model


def classified(features: DataFrame, model: Mixture) -> DataFrame:
    """(doc_id, kind, prose): the kind of each document, and the responsibility of prose."""
    kind_of = model.kinds.argmax(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, r, _ = model.responsibilities(_rows(batch))
                share = np.stack([r[:, kind_of == k].sum(1) for k in range(len(KINDS))], axis=1)
                yield pa.record_batch({"doc_id": batch.column("doc_id"), "kind": pa.array([KINDS[i] for i in share.argmax(1)]), "prose": pa.array(share[:, 0])})

    return features.select("doc_id", "f").mapInArrow(run, "doc_id bigint, kind string, prose double")

"""Problem 6: records that share most of their words, all of them, by a generalised pigeonhole search over word sets.

Every report becomes its set of distinct words; equal sets are one class from here on. A set is a bit vector over the
vocabulary. If two sets reach the similarity threshold, at most n - ceil(t n) of the n words of either are missing in the
other. The words of a set are put into partitions; partition i, holding k_i of the words looked at, has the threshold
k_i - w_i: as long as no more of them are missing, w_i words of it are left that both sets have. Where the sum of
(threshold + 1) over the partitions exceeds n - ceil(t n), one partition must stay within its threshold, so both sets hold
one common signature, w_i words of one partition. A signature of several words is far rarer than any of them, which is what
a plain prefix filter lacks.

* Partitions group words that occur about equally often: a band for each power of two of the count, split into groups.
  Words are looked at in one global order, rarest first, only until the thresholds add up.
* The width w_i and the number of groups of each band are allocated by dynamic programming (`allocate`) on the estimated
  numbers of candidates and probes, from the counts of all words: rare words are partitions of their own of width 1,
  frequent ones get wider signatures as the collection grows.
* Probing is one exchange on the signatures. Rows of one signature are paired if their sizes, the thresholds used up before
  that signature, and the parities of their words' bits (a lower bound of the words in which two sets differ) allow it.
* What is left is verified exactly on the word sets.

No step can lose a pair at the threshold. A set whose partitions don't reach the sum (of few words, or with all of them in
one partition) is probed word by word; the others then also give the single words that such sets ask for. Signatures of
more than BLOCK rows are named and then paired block against block. Nothing is capped.

Reports without words are in no pair. Null title or content counts as empty. Words are 64-bit hashes: of 10 million
different words two share one with a chance of 3 in a million.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .canonical import by_script, canonical_texts
from .common import kept
from .lines import removers_of

THRESHOLD = 0.6
#: Hash buckets that words are counted in, and those of words asked for singly: tables of fixed size, whatever the vocabulary.
BUCKETS, ASKED = 2**20, 2**18
#: Bands of word counts; the widths and numbers of groups that a band may get; how many candidates cost as much as a probe.
BANDS, WIDTHS, GROUPS, PROBE_COST = 33, (1, 2, 3), (1, 2, 3, 4, 6, 8), 6_000
#: Rows of a signature that are paired in memory; rows that are looked at together.
BLOCK, TOGETHER = 100_000, 400_000
#: Columns of 64 parities each.
PARITY = ("p0", "p1", "p2")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: Column) -> Column:
    """Sorted distinct 64-bit hashes of the runs of letters and digits, in lower case."""
    return F.sort_array(F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.xxhash64(w))))


_WORD = re.compile(r"[^\W_]+")
_FACTOR = 0xD1342543DE82EF95


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each code point below 65,536, whether it is a letter or digit, and a random number."""
    plain = np.fromiter((chr(c).isalnum() for c in range(65536)), bool, 65536)
    return plain, np.random.default_rng(2).integers(0, 2**63, 65536).astype(np.uint64) * np.uint64(2) + np.uint64(1)


_ALNUM, _NUMBER = _tables()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct words of each text, sorted: words are the runs of letters and digits, in lower case.

    A word's hash is the sum of its characters' random numbers times the powers of an odd factor, modulo 2^64, so that all words of
    a batch are hashed at once; in Python word by word, finding and hashing take several times the CPU (measured).
    """
    low = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, low), np.int64, len(low)) + 1
    codes = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    high = codes > 65535
    of = np.minimum(codes, 65535)
    word, number = _ALNUM[of], _NUMBER[of]
    if high.any():
        every, back = np.unique(codes[high], return_inverse=True)
        word[high] = np.array([chr(c).isalnum() for c in every])[back]
        number[high] = ((every.astype(np.uint64) * _ODD) | np.uint64(1))[back]
    at = np.flatnonzero(word)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    sizes = np.diff(np.append(starts, len(at)))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), _FACTOR, np.uint64))
        powers = powers[np.arange(len(at)) - np.repeat(starts, sizes)]
        hashes = _mix(np.add.reduceat(number[at] * powers, starts), np.uint64(3))
    row = np.repeat(np.arange(len(low)), lengths)[at[starts]]
    order = np.argsort((row.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    if ((row[order][1:] == row[order][:-1]) & (hashes[order][1:] < hashes[order][:-1])).any() or len(low) > 65535:
        order = np.lexsort((hashes, row))  # the first 48 bits were not enough
    row, hashes = row[order], hashes[order]
    new = np.append(True, (np.diff(row) != 0) | (hashes[1:] != hashes[:-1]))
    return row[new], hashes[new]


def word_sets(docs: DataFrame, usual: dict[tuple[str, str], str]) -> DataFrame:
    """(id, class, words): sorted distinct word hashes of title and content, less the source's lines, in canonical form.

    docs: (id, title, content, lines). Cutting lines, normalising and splitting need many small regular expressions on
    every text, for which one Arrow pass takes about half the CPU of the same steps as JVM expressions (measured).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms, removers = by_script(usual), {}
        hasher = xxhash.xxh64_intdigest
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                texts = []
                for title, content, remove in zip(batch.column("title").to_pylist(), batch.column("content").to_pylist(), removers_of(batch.column("lines"), removers)):
                    content = content or ""
                    if remove:
                        content = remove(content)
                    texts.append(f"{title}\n{content}" if title else content)
                row, words = word_hashes(canonical_texts(texts, forms))
                ends = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
                data = words.tobytes()
                classes = np.array([hasher(data[a * 8 : b * 8]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(classes), pa.ListArray.from_arrays(pa.array(ends), pa.array(words.view(np.int64)))], names=["id", "class", "words"])

    return docs.select("id", "title", "content", "lines").mapInArrow(run, "id string, class bigint, words array<bigint>")


class Sets(NamedTuple):
    """The word sets of a batch, words of one set in the global order: rarest first, then by hash."""

    ids: np.ndarray
    sizes: np.ndarray
    row: np.ndarray
    words: np.ndarray
    often: np.ndarray
    place: np.ndarray


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("class").to_numpy(zero_copy_only=False)
    lists = batch.column("words")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return ids, lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].view(np.uint64), np.diff(offsets)


def _bucket(words: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    return ((words * _ODD) >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


def _mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    c = (a ^ (b + np.uint64(0x2545F4914F6CDD1D))) * _ODD
    return c ^ (c >> np.uint64(29))


def _sets(batch: pa.RecordBatch, counts: np.ndarray) -> Sets:
    ids, words, sizes = _flat(batch)
    row = np.repeat(np.arange(len(ids)), sizes)
    often = counts[_bucket(words)]
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(words)) - starts[row]
    # One sort of the rows, counts and first bits of the words together; a full one if these bits were not enough.
    order = np.argsort((row.astype(np.uint64) << np.uint64(48)) | np.minimum(often, 2**24 - 1).astype(np.uint64) << np.uint64(24) | words >> np.uint64(40))
    w, n = words[order], often[order]
    if len(ids) > 65_536 or ((place[1:] > 0) & ((n[1:] < n[:-1]) | ((n[1:] == n[:-1]) & (w[1:] < w[:-1])))).any():
        order = np.lexsort((words, often, row))
        w, n = words[order], often[order]
    return Sets(ids, sizes, row, w, n, place)


def word_counts(classes: DataFrame) -> np.ndarray:
    """How often the words of each of BUCKETS hash buckets occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += np.bincount(_bucket(_flat(batch)[1]), minlength=BUCKETS)
        some = np.nonzero(counts)[0]
        yield pa.record_batch({"bucket": some.astype(np.int32), "n": counts[some]})

    rows = classes.select("class", "words").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(BUCKETS, np.uint32)
    counts[rows.column("bucket").to_numpy()] = np.minimum(rows.column("n").to_numpy(), 2**32 - 1)
    return counts


class Plan(NamedTuple):
    """Width and number of groups of each band of word counts; bands of width 1 need no groups."""

    width: np.ndarray
    groups: np.ndarray


def _poisson(mean: float, most: int = 60) -> np.ndarray:
    k = np.arange(most)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, most)))])
    return np.exp(k * math.log(max(mean, 1e-12)) - mean - logs)


def allocate(counts: np.ndarray, classes: int, threshold: float = THRESHOLD, steps: int = 64, slack: float = 1.3) -> Plan:
    """Widths and groups of the bands, by dynamic programming: least estimated cost of reaching the sum of thresholds.

    Bands are taken rarest first, as words are. Of a band with x words in a set on average, in g groups of width w, a group
    holds k words (Poisson): it brings k - w + 1 to the sum and C(k, w) probes, each of which meets as many candidates as
    sets hold its w words. The state is the sum so far, in 1/steps. The sum wanted is that of an average set with some
    slack. Bands that an average set does not reach get pairs.
    """
    n = counts[counts > 0].astype(np.float64)
    band = np.minimum(np.log2(n).astype(int), BANDS - 1)
    held = np.bincount(band, n, BANDS)
    words = np.bincount(band, minlength=BANDS)
    width, groups = np.full(BANDS, 2), np.full(BANDS, GROUPS[-1])
    if not classes or not len(n):
        return Plan(width, groups)
    mean_size = held.sum() / classes
    need = math.ceil(((1 - threshold) * mean_size + 1) * slack * steps)
    least, via = [0.0] + [math.inf] * need, [[None] * (need + 1) for _ in range(BANDS)]
    for b in range(BANDS):
        if not held[b]:
            continue
        x, each = held[b] / classes, held[b] / words[b]
        options = [(x, x * (PROBE_COST if b else 0) + x * each / 2, 1, 1)]
        for w in WIDTHS[1:]:
            for g in GROUPS:
                p, k = _poisson(x / g), np.arange(60)
                probes = g * (x / g) ** w / math.factorial(w)
                options.append((g * float((p * np.maximum(k - w + 1, 0)).sum()), probes * (PROBE_COST + classes * (each / classes) ** w / 2), w, g))
        new = [math.inf] * (need + 1)
        for q, cost in enumerate(least):
            if cost == math.inf:
                continue
            if q == need:
                if cost < new[q]:
                    new[q], via[b][q] = cost, (q, 0, 0)
                continue
            for gain, own, w, g in options:
                step = int(gain * steps)
                # A set stops at the word with which the sum is reached: of the last band it uses a part.
                part = min(1.0, (need - q) / max(gain * steps, 1e-9))
                to = min(need, q + step)
                if (total := cost + own * part) < new[to]:
                    new[to], via[b][to] = total, (q, w, g)
        least = new
    q = need if least[need] < math.inf else max((i for i, c in enumerate(least) if c < math.inf), default=0)
    for b in range(BANDS - 1, -1, -1):
        if via[b][q]:
            q, w, g = via[b][q]
            if w:
                width[b], groups[b] = w, g
    return Plan(width, groups)


def _thresholds(s: Sets, plan: Plan, t: int) -> tuple[np.ndarray, ...]:
    """(part, before, use, deficient, need): of each word its partition, the sum of (threshold + 1) before it and whether it is
    looked at; of each set whether its partitions don't reach the sum, and the sum."""
    need = s.sizes - -(-t * s.sizes // 1000) + 1
    band = np.minimum(np.log2(np.maximum(s.often, 1)).astype(np.int64), BANDS - 1)
    width = plan.width[band]
    part = (s.row * BANDS + band) * GROUPS[-1] + ((s.words >> np.uint64(7)) % plan.groups[band].astype(np.uint64)).astype(np.int64)
    wide = np.flatnonzero(width > 1)
    order = wide[np.argsort(part[wide], kind="stable")]
    first = np.flatnonzero(np.diff(part[order], prepend=-1))
    rank = np.zeros(len(part), np.int64)
    rank[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    unit = (rank >= width - 1).astype(np.int64)
    after = np.cumsum(unit)
    ends = np.cumsum(s.sizes)
    total = np.append(0, after)[ends]
    start = np.append(0, after)[ends - s.sizes]
    before = after - unit - start[s.row]
    return part, before, before < need[s.row], total - start < need, need


def _maybe_deficient(batch: pa.RecordBatch, counts: np.ndarray, plan: Plan, t: int) -> np.ndarray:
    """Whether a set's words of width 1, which bring 1 each, fall short of the sum: only such a set can be deficient."""
    _, words, sizes = _flat(batch)
    single = plan.width[np.minimum(np.log2(np.maximum(counts[_bucket(words)], 1)).astype(np.int64), BANDS - 1)] == 1
    brought, ends = np.append(0, np.cumsum(single)), np.cumsum(sizes)
    return brought[ends] - brought[ends - sizes] < sizes - -(-t * sizes // 1000) + 1


def _size_class(n: np.ndarray) -> np.ndarray:
    return (np.log2(np.maximum(n, 1)) * 2).astype(np.int64)


def asked_words(classes: DataFrame, counts: np.ndarray, plan: Plan, threshold: float = THRESHOLD) -> np.ndarray:
    """The single words that deficient sets ask for, as sorted codes of size class and hash bucket: at most ASKED for each of
    the few size classes."""
    t = round(threshold * 1000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_maybe_deficient(batch, counts, plan, t)))
            if batch.num_rows:
                s = _sets(batch, counts)
                _, _, _, deficient, need = _thresholds(s, plan, t)
                hit = deficient[s.row] & (s.place < need[s.row]) & (s.often > 1)
                yield pa.record_batch({"code": np.unique(_size_class(s.sizes[s.row[hit]]) * ASKED + _bucket(s.words[hit], ASKED))})

    return np.sort(classes.select("class", "words").mapInArrow(run, "code bigint").distinct().toArrow().column("code").to_numpy())


def signatures(classes: DataFrame, counts: np.ndarray, plan: Plan, asked: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """(key, class, p0, p1, p2): one row per class and signature.

    key packs 32 bits of the signature's hash, the number of words, and the most words that a partner may have: the sum
    before the signature is what must be missing if it is the first one in common. Numbers beyond 65,535 count as that,
    which only lets pairs through. p0, p1 and p2 have the parities of the words' bits.
    """
    t, most_words = round(threshold * 1000), 65_535

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                s = _sets(whole.slice(lo, 2000), counts)
                if not len(s.words):
                    continue
                part, before, use, deficient, need = _thresholds(s, plan, t)
                bits = ((s.words * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) % np.uint64(64 * len(PARITY))
                one, starts = np.uint64(1) << (bits & np.uint64(63)), np.cumsum(s.sizes) - s.sizes
                parity = [np.bitwise_xor.reduceat(np.where(bits >> np.uint64(6) == i, one, np.uint64(0)), starts) for i in range(len(PARITY))]
                fine = ~deficient[s.row]
                width = plan.width[np.minimum(np.log2(np.maximum(s.often, 1)).astype(np.int64), BANDS - 1)]
                use &= fine & (s.often > 1)  # a word of one set makes no signature
                one = np.flatnonzero(use & (width == 1))
                keys, at = [_mix(s.words[one], np.uint64(0))], [one]
                wide = np.flatnonzero(use & (width > 1))
                i = wide[np.argsort(part[wide], kind="stable")]
                p, step = part[i], 1
                pairs = np.arange(len(i))
                while len(pairs := pairs[pairs + step < len(i)]):
                    pairs = pairs[p[pairs] == p[pairs + step]]
                    a, b = i[pairs], i[pairs + step]
                    two = width[a] == 2
                    keys.append(_mix(s.words[a[two]], s.words[b[two]]))
                    at.append(b[two])
                    three = pairs[~two]
                    more = 1
                    while len(three := three[three + step + more < len(i)]):
                        three = three[p[three] == p[three + step + more]]
                        c = i[three + step + more]
                        keys.append(_mix(_mix(s.words[i[three]], s.words[i[three + step]]), s.words[c]))
                        at.append(c)
                        more += 1
                    step += 1
                places = [before[x] for x in at]
                if len(asked):
                    single = (s.place < need[s.row]) & (s.often > 1)
                    own, wanted = _size_class(s.sizes)[s.row], _bucket(s.words, ASKED)
                    hit = deficient[s.row] & single
                    for d in (-2, -1, 0, 1, 2):
                        code = (own + d) * ASKED + wanted
                        found = np.minimum(np.searchsorted(asked, code), len(asked) - 1)
                        hit |= single & (asked[found] == code)
                    x = np.flatnonzero(hit)
                    keys.append(_mix(s.words[x], np.uint64(1)))
                    at.append(x)
                    places.append(s.place[x])
                x, key, gone = np.concatenate(at), np.concatenate(keys), np.concatenate(places)
                row = s.row[x]
                n = s.sizes[row]
                most = (n - gone) * (1000 + t) // t - n
                key = (key & np.uint64(0xFFFFFFFF00000000)).view(np.int64) | np.minimum(n, most_words) << 16 | np.clip(most, 0, most_words)
                yield pa.record_batch({"key": key, "class": s.ids[row]} | {c: h[row].view(np.int64) for c, h in zip(PARITY, parity)})

    return classes.select("class", "words").mapInArrow(run, "key bigint, class bigint, " + ", ".join(f"{c} bigint" for c in PARITY))


def _met(key: np.ndarray, ids: np.ndarray, parity: list[np.ndarray], t: int) -> list[np.ndarray]:
    """Pairs (2, n) of the rows of equal signatures that sizes and parities allow. Rows are sorted by key, so by size within a signature."""
    group, n, most = key >> 32, (key >> 16) & 0xFFFF, key & 0xFFFF
    # Partners of a row follow it up to the last one small enough.
    limit = np.minimum(np.minimum(n * 1000 // t, most), 0xFFFF)
    end = np.searchsorted(key, (group << 32) | (limit << 16) | 0xFFFF, "right")
    length = np.maximum(end - np.arange(len(key)) - 1, 0)
    found: list[np.ndarray] = []

    def keep(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> None:
        ok = (apart.astype(np.int64) * (1000 + t) <= (n[a] + n[b]) * (1000 - t)) & (most[b] >= n[a]) & (ids[a] != ids[b])
        if ok.any():
            x, y = ids[a[ok]], ids[b[ok]]
            found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))

    # Long runs: tiles of rows against blocks of columns, two of the parities first, the last where those allow the pair. The rows of a
    # stretch are taken by where their partners end, and columns that want smaller partners than the tile has are left out: a row's
    # words before the signature narrow its partners so much that most pairs of a signature needn't be looked at.
    tall, wide, stretch, far = 64, 1024, 512, 24
    big = np.flatnonzero(length > far)
    both, one, more = np.empty(tall * wide, np.uint64), np.empty(tall * wide, np.uint8), np.empty(tall * wide, np.uint8)
    edges = np.append(np.flatnonzero(np.diff(group[big], prepend=-(2**40))), len(big)).tolist()
    for begin, stop in zip(edges, edges[1:]):
        for lo in range(begin, stop, stretch):
            by_end = big[lo : min(lo + stretch, stop)]
            by_end = by_end[np.argsort(end[by_end], kind="stable")]
            for k in range(0, len(by_end), tall):
                rows = by_end[k : k + tall]
                r, start, least, widest = len(rows), int(rows.min()) + 1, n[rows].min(), int(n[rows].max())
                columns = start + np.flatnonzero(most[start : end[rows[-1]]] >= least)
                own = [h[rows][:, None] for h in parity]
                for c in range(0, len(columns), wide):
                    cols = columns[c : c + wide]
                    size = r * len(cols)
                    x, apart, extra = (m[:size].reshape(r, len(cols)) for m in (both, one, more))
                    for i, (h, mine) in enumerate(zip(parity, own)):
                        np.bitwise_xor(mine, h[cols], out=x)
                        np.bitwise_count(x, out=extra if i else apart)
                        if i:
                            np.add(apart, extra, out=apart)
                    bound = np.minimum((n[cols] + widest) * (1000 - t) // (1000 + t), 255).astype(np.uint8)
                    near = np.flatnonzero(apart <= bound)
                    if len(near):
                        a, b = rows[near // len(cols)], cols[near % len(cols)]
                        ok = (b > a) & (b < end[a])
                        keep(a[ok], b[ok], one[near[ok]])
    small = np.flatnonzero((length > 0) & (length <= far))
    small = small[np.argsort(-length[small], kind="stable")]
    ahead = -length[small]
    step, left = 1, len(small)
    while left:
        a = small[:left]
        b = a + step
        apart = sum(np.bitwise_count(h[a] ^ h[b]) for h in parity)
        near = apart <= np.minimum((n[a] + n[b]) * (1000 - t) // (1000 + t), 255)
        keep(a[near], b[near], apart[near])
        step += 1
        left = int(np.searchsorted(ahead, -step, "right"))
    return found


def _near_pairs(t: int, block: int | None):
    """Pairs of classes of rows sorted by key. A signature of more than `block` rows is named instead, as (signature, signature, true)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            key, ids, *parity = (np.concatenate(x) for x in zip(*parts))
            found = _met(key, ids, parity, t)
            if found:
                a, b = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.record_batch({"a": a, "b": b, "hot": np.zeros(len(a), bool)})

        # Rows of whole signatures are gathered until they are worth while; the last signature of a batch may go on.
        gathered, held, last, lasting, hot = [], 0, [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy().view(np.int64 if i < 2 else np.uint64) for i in range(2 + len(PARITY))]
            group = rows[0] >> 32
            if hot is not None:
                rows = [x[np.searchsorted(group, hot, "right") :] for x in rows]
                if not len(rows[0]):
                    continue
                group, hot = rows[0] >> 32, None
            cut = int(np.searchsorted(group, group[-1]))
            if last and group[0] != last[0][0][0] >> 32:
                gathered, held, last, lasting = gathered + last, held + lasting, [], 0
            if cut:
                gathered, held, last, lasting = gathered + last + [[x[:cut] for x in rows]], held + lasting + cut, [], 0
            last.append([x[cut:].copy() for x in rows])
            lasting += len(rows[0]) - cut
            if block and lasting > block:
                hot, last, lasting = int(group[-1]), [], 0
                yield pa.record_batch({"a": [hot], "b": [hot], "hot": [True]})
            if held > TOGETHER:
                yield from of(gathered)
                gathered, held = [], 0
        if gathered or last:
            yield from of(gathered + last)

    return run


def candidates(classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(a, b): distinct pairs of classes, among them every pair at the threshold. classes: (class, words), a kept table."""
    t, spark = round(threshold * 1000), classes.sparkSession
    counts = word_counts(classes)
    plan = allocate(counts, classes.count(), threshold)
    rows = signatures(classes, counts, plan, asked_words(classes, counts, plan, threshold), threshold)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    of = F.shiftright("key", 32)
    near = rows.repartition(parts, of).sortWithinPartitions("key").mapInArrow(_near_pairs(t, block), "a bigint, b bigint, hot boolean")
    met = kept(near.distinct())
    found = met.where("NOT hot").select("a", "b")
    keys = met.where("hot").select(F.col("a").alias("signature"))
    if not keys.isEmpty():
        # The rows of a hot signature in blocks, each pair of blocks being a signature of its own.
        own = kept(rows.withColumn("signature", of).join(keys, "signature", "left_semi"))
        size = own.groupBy("signature").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
        mine = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
        cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.xxhash64("signature", F.least(mine, j), F.greatest(mine, j)))
        spread = own.join(size, "signature").select(F.explode(cells).alias("cell"), "key", "class", *PARITY)
        rekeyed = spread.select(F.shiftleft(F.shiftright("cell", 32), 32).bitwiseOR(F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"), "class", *PARITY)
        found = found.unionByName(rekeyed.repartition(parts, of).sortWithinPartitions("key").mapInArrow(_near_pairs(t, None), "a bigint, b bigint, hot boolean").select("a", "b")).distinct()
    return found


def verified(pairs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, jaccard): the pairs whose word sets are as similar as the threshold, exactly. pairs is a kept table."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    w = classes.join(ends, "class", "left_semi").select("class", "words")
    both = pairs.join(w.withColumnsRenamed({"class": "a", "words": "wa"}), "a").join(w.withColumnsRenamed({"class": "b", "words": "wb"}), "b")
    shared = F.size(F.array_intersect("wa", "wb"))
    union = F.size("wa") + F.size("wb") - shared
    return both.select("a", "b", shared.alias("s"), union.alias("u")).where(F.col("s") * 1000 >= F.col("u") * round(threshold * 1000)).select("a", "b", (F.col("s") / F.col("u")).alias("jaccard"))


def word_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs: (id, words) or (id, class, words), rows of one id being equal. Returns members (id, class), each once, and classes
    (class, words), one row per class. Both are read from one table written here.

    Of a class with several rows the first one stands for it; only classes with several rows are joined, the words of the
    others stay where they are.
    """
    if "class" not in docs.columns:
        docs = docs.withColumn("class", F.xxhash64("words"))
    docs = kept(docs.where(F.size("words") > 0).select("id", "class", "words").withColumn("row", F.monotonically_increasing_id()))
    first = kept(docs.groupBy("class").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").select("class", "first"))
    classes = docs.select("class", "words", "row").join(first, "class", "left").where("first IS NULL OR first = row").select("class", "words")
    return docs.select("id", "class").distinct(), classes


def similar_classes(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, jaccard) of all pairs of classes at the threshold, each once."""
    return verified(kept(candidates(classes, threshold)), classes, threshold)


def expanded(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id_a, id_b): the pairs of reports behind the links, and the pairs of equal reports; the smaller id first."""
    a, b = members.withColumnsRenamed({"class": "a", "id": "x"}), members.withColumnsRenamed({"class": "b", "id": "y"})
    linked = links.select("a", "b").join(a, "a").join(b, "b").select("x", "y")
    many = members.groupBy("class").count().where("count > 1").select("class")
    copies = members.join(many, "class")
    same = copies.withColumnRenamed("id", "x").join(copies.withColumnRenamed("id", "y"), "class").where("x < y").select("x", "y")
    return linked.unionByName(same).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))

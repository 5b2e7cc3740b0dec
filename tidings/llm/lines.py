"""Problem 2: lines that return in many documents of one source.

Lines are nodes of one graph per source, consecutive lines are its edges, both weighted by the number of distinct
reports that hold them. Nodes and edges of high support stay; the connected components of what stays are the
boilerplate blocks (legal notice, share prompt, byline under one another). Where lines of one block follow one another in a
document, blank ones between them included, the block occurs there and is deleted; a line that stands alone in the graph is
a block of one line.

Counting never gathers a source: (source, line, report) is reduced first, and the counts are partial aggregates. What
stays is small by proof: a node stands in at least a tenth of its source's reports, so a source keeps at most ten times
as many nodes as its reports have lines on average; the graph's components are therefore taken per source.

Null and empty contents have no lines; a report without a usable source keeps all its lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import if_small

MIN_REPORTS, MIN_SHARE = 4, 0.1


# Fixed value: white space within a line, other than the usual blank.
_OTHER_BLANK = r"\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNEVEN = f"[{_OTHER_BLANK}][ {_OTHER_BLANK}]*| [ {_OTHER_BLANK}]+"


def line_texts(text: Column) -> Column:
    """The lines of a text in the form in which they are compared: lines that differ only in the amount of blanks, letter
    case or the digits of their numbers are equal. The rules are applied to the whole text at once, before it is split."""
    low = F.lower(text)
    even = F.when(low.contains("  ") | low.rlike(f"[{_OTHER_BLANK}]"), F.regexp_replace(low, _UNEVEN, " ")).otherwise(low)
    return F.transform(F.split(F.regexp_replace(even, r"\p{Nd}+", "0"), "\n"), lambda line: F.trim(line))


def line_keys(text: Column) -> Column:
    """The key of every line of a text, equal for lines of equal line_texts(); null at blank lines."""
    return F.transform(line_texts(text), lambda line: F.when(line != "", F.xxhash64(line).bitwiseAND(F.lit(~0xFFFF)).bitwiseOR(_first(line))))


_ODD_BLANK = re.compile("[\t\x0b\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_EVEN = re.compile(f"{_ODD_BLANK.pattern}[ {_ODD_BLANK.pattern[1:-1]}]*| [ {_ODD_BLANK.pattern[1:-1]}]+")
_DIGITS = re.compile(r"\d+")


def _evened(text: str) -> str:
    """Each run of blanks within a line as one blank; only texts with others than single ones are rewritten."""
    return _EVEN.sub(" ", text) if "  " in text or _ODD_BLANK.search(text) else text


def line_key(line: str) -> int | None:
    """line_keys() of one line, outside the JVM."""
    plain = _DIGITS.sub("0", _evened(line.lower())).strip(" ")
    if not plain:
        return None
    key = (xxhash.xxh64_intdigest(plain.encode(), 42) & ~0xFFFF) | (ord(plain[0]) & 0xFFFF)
    return key - 2**64 if key >= 2**63 else key


class Remover:
    """without_lines() outside the JVM, for one source's lines."""

    def __init__(self, keys) -> None:
        self.keys = frozenset(keys)
        self.firsts = frozenset(k & 0xFFFF for k in keys)

    def __call__(self, text: str) -> str:
        return "\n".join([line for line in text.split("\n") if not self._repeated(line)])

    def _repeated(self, line: str) -> bool:
        start = line.lstrip(" ")[:1]
        if not start or not (ord(start.lower()[0]) & 0xFFFF in self.firsts or start.isdigit() or _ODD_BLANK.match(start)):
            return False
        return line_key(line) in self.keys


def removers_of(lines: pa.ListArray, known: dict[bytes, Remover]) -> list[Remover | None]:
    """The remover of each row's lines, None where there are none; `known` holds those made so far, one per source."""
    offsets, keys = lines.offsets.to_numpy().tolist(), lines.values.to_numpy(zero_copy_only=False)
    out: list[Remover | None] = []
    for a, b in zip(offsets, offsets[1:]):
        if a == b:
            out.append(None)
            continue
        own = keys[a:b]
        name = own.tobytes()
        out.append(known.get(name) or known.setdefault(name, Remover(own.tolist())))
    return out


def _first(line: Column) -> Column:
    """The first character's code; it is the key's low 16 bits, the rest is a hash of the line."""
    return F.ascii(line).bitwiseAND(F.lit(0xFFFF)).cast("bigint")


def _supports(keyed: DataFrame, item: str) -> DataFrame:
    """Reports per (source, item): an item within one report counts once."""
    return keyed.groupBy("source", item).agg(F.count("*").alias("reports"))


def repeated_lines(docs: DataFrame, min_reports: int = MIN_REPORTS, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, line, reports): the nodes of high support. docs: (id, source, keys), one row per report, source not null."""
    total = docs.groupBy("source").agg(F.count("*").alias("all"))
    lines = docs.select("source", F.explode(F.array_distinct(F.array_compact("keys"))).alias("line"))
    return (
        _supports(lines, "line")
        .where(F.col("reports") >= min_reports)
        .join(total, "source")
        .where(F.col("reports") >= F.col("all") * min_share)
        .select("source", "line", "reports", "all")
    )


def repeated_edges(docs: DataFrame, min_reports: int = MIN_REPORTS, min_share: float = MIN_SHARE) -> DataFrame:
    """(source, a, b, reports): consecutive lines (blank ones skipped) of high support."""
    k = F.array_compact("keys")
    pairs = F.arrays_zip(F.slice(k, 1, F.greatest(F.size(k) - 1, F.lit(0))).alias("a"), F.slice(k, 2, F.greatest(F.size(k) - 1, F.lit(0))).alias("b"))
    total = docs.groupBy("source").agg(F.count("*").alias("all"))
    edges = docs.select("source", F.explode(F.array_distinct(pairs)).alias("edge"))
    return (
        _supports(edges, "edge")
        .where(F.col("reports") >= min_reports)
        .join(total, "source")
        .where(F.col("reports") >= F.col("all") * min_share)
        .select("source", F.col("edge.a").alias("a"), F.col("edge.b").alias("b"), "reports")
    )


def blocks(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, block, line, reports): connected components of the kept graph; a block is named by its smallest line."""
    kinds = nodes.select("source", "line", F.lit(None).cast("bigint").alias("b"), "reports").unionByName(edges.select("source", F.col("a").alias("line"), "b", "reports"))

    def components(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf.b.isna()]
        lines = [int(x) for x in own.line]
        parent = {x: x for x in lines}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        pairs = pdf[pdf.b.notna()]
        for a, b in zip(pairs.line, pairs.b.astype("int64")):
            if int(a) in parent and int(b) in parent:
                a, b = find(int(a)), find(int(b))
                parent[max(a, b)] = min(a, b)
        return pd.DataFrame({"source": own.source, "block": [find(x) for x in lines], "line": lines, "reports": list(own.reports)})

    # A 64-bit key must not pass through a float column: b is carried as text.
    return (
        kinds.withColumn("b", F.col("b").cast("string"))
        .groupBy("source")
        .applyInPandas(components, "source string, block bigint, line bigint, reports bigint")
    )


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """(id, source, keys): line_keys() of each text by one Arrow pass, at about a third of the JVM expressions' CPU (measured)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            keys, ends, none = [], [0], []
            for text in batch.column(2).to_pylist():
                none.append(text is None)
                for line in _DIGITS.sub("0", _evened((text or "").lower())).split("\n") if text is not None else ():
                    line = line.strip(" ")
                    if line:
                        key = (digest(line.encode(), 42) & ~0xFFFF) | (ord(line[0]) & 0xFFFF)
                        keys.append(key - 2**64 if key >= 2**63 else key)
                    else:
                        keys.append(None)
                ends.append(len(keys))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.int64()), mask=pa.array(none, pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "source", "keys"])

    return docs.select("id", "source", text).mapInArrow(run, "id string, source string, keys array<bigint>")


def per_source(nodes: DataFrame) -> DataFrame:
    """(source, lines): the kept lines of a source as one array; at most some tens of lines per source.

    Marked for broadcast if the count, taken here, shows that it is small.
    """
    return if_small(nodes.groupBy("source").agg(F.collect_set("line").alias("lines")))


def block_of(keys: Column, marks: Column) -> Column:
    """Of every line key the block that the line belongs to, null if none. marks: an array of (line, block), or null."""
    known = F.map_from_entries(marks)
    return F.transform(keys, lambda k: F.when(k.isNotNull(), F.try_element_at(known, k)))


def marks_per_source(blocks: DataFrame) -> DataFrame:
    """(source, marks): the lines of a source's blocks as one array of (line, block); marked for broadcast if that is small."""
    return if_small(blocks.groupBy("source").agg(F.collect_list(F.struct("line", "block")).alias("marks")))


def without_blocks(docs: DataFrame, text: str) -> DataFrame:
    """(id, text): each text without the occurrences of its source's blocks. docs: (id, text, marks), marks of marks_per_source()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if t and marks:
                    known = {m["line"]: m["block"] for m in marks}
                    kept_lines, blanks, before = [], [], None
                    for line in t.split("\n"):
                        key = line_key(line)
                        if key is None:
                            blanks.append(line)
                            continue
                        block = known.get(key)
                        # Blank lines go only if the same block stands on both sides of them.
                        if block is None or block != before:
                            kept_lines += blanks
                        if block is None:
                            kept_lines.append(line)
                        blanks, before = [], block
                    t = "\n".join(kept_lines + blanks)
                out.append(t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["id", text])

    return docs.select("id", text, "marks").mapInArrow(run, f"id string, {text} string")


def without_lines(text: Column, lines: Column) -> Column:
    """The text without the lines whose key is in `lines` (null: none); the others stay as they are.

    A key is only made of a line that starts as one of `lines` does, or with a blank or a digit, which keys don't tell apart.
    """
    firsts = F.array_distinct(F.transform(lines, lambda key: key.bitwiseAND(F.lit(0xFFFF))))

    def repeated(line: Column) -> Column:
        start = F.substring(F.ltrim(line), 1, 1)
        may = F.array_contains(firsts, _first(F.lower(start))) | start.rlike(f"[{_OTHER_BLANK}\\p{{Nd}}]")
        return F.when(may, F.coalesce(F.array_contains(lines, line_keys(line)[0]), F.lit(False))).otherwise(False)

    return F.when(lines.isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), lambda line: ~repeated(line)), "\n"))

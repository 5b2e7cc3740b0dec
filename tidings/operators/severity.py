"""Severity by word lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.language import has_any

RANK = {s: i for i, s in enumerate(X.SEVERITIES)}


def severity(matchable: Column, default: Column | str = "low", words: dict[str, list[str]] | None = None, calming: list[str] | None = None) -> Column:
    """The gravest level with a word in the text; critical and high become medium beside a calming phrase; else the default."""
    calm = has_any(matchable, X.CALMING if calming is None else calming)
    default = F.lit(default) if isinstance(default, str) else default
    out = None
    for level, own in (words or X.SEVERITY).items():
        value = F.when(calm, F.lit("medium")).otherwise(F.lit(level)) if level in ("critical", "high") else F.lit(level)
        hit = has_any(matchable, own)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.when(F.coalesce(matchable, F.lit("")) == "", default).otherwise(out.otherwise(default))


def rank(c: Column) -> Column:
    """0 to 3; unknown and null count as the lowest."""
    out = F.lit(0)
    for s, i in RANK.items():
        out = F.when(c == s, F.lit(i)).otherwise(out)
    return out


def gravest(c: Column) -> Column:
    """Aggregate: the severity of the highest rank."""
    return F.element_at(F.array(*[F.lit(s) for s in X.SEVERITIES]), F.max(rank(c)) + 1)

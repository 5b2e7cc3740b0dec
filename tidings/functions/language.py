"""Shares of letters by script, and terms in texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import RulePack
from .text import matchable_literal

LETTER = r"[\p{L}\p{Nl}\p{No}]"


def letter_share(c: Column, letters: str) -> Column:
    n = F.regexp_count(c, F.lit(LETTER))
    return F.when(n > 0, F.regexp_count(c, F.lit(letters)) / n).otherwise(0.0)


def in_language(c: Column, pack: RulePack) -> Column:
    """Enough letters, and enough of them of the pack's script."""
    n = F.regexp_count(c, F.lit(LETTER))
    return F.coalesce((n >= pack.least_letters) & (F.regexp_count(c, F.lit(pack.letters)) >= n * pack.least_share), F.lit(False))


def in_other_script(c: Column, pack: RulePack) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(pack.other_letters)) > pack.most_other, F.lit(False))


def terms(words) -> list[str]:
    """Words in matchable form, in order, each once, without empty ones."""
    return list(dict.fromkeys(w for w in map(matchable_literal, words) if w))


def has_any(c: Column, words) -> Column:
    """A text in matchable form has one of the words, also inside other words."""
    found = F.lit(False)
    for w in terms(words):
        found = found | c.contains(w)
    return found


def term_in(c: Column, word: str) -> Column:
    """Short words must stand by themselves, others may be part of a word."""
    w = matchable_literal(word)
    if not w:
        return F.lit(False)
    return F.concat(F.lit(" "), c, F.lit(" ")).contains(f" {w} ") if len(w) <= 3 else c.contains(w)


def first_term(c: Column, words) -> Column:
    """The first word of the list (as it stands there) that the text has, or null."""
    hits = [F.when(term_in(c, w), F.lit(w)) for w in words]
    return F.coalesce(*hits, F.lit(None).cast("string")) if hits else F.lit(None).cast("string")

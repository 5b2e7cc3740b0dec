"""Tokens that carry meaning, and similarity of token sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as X


def without_attached(w: Column) -> Column:
    """A word without the letter attached to it; short words stay."""
    n, rest = F.length(w), F.substring(w, F.lit(2), F.length(w))
    inner = F.when((F.length(rest) > 3) & rest.startswith("ה"), F.substring(rest, F.lit(2), n)).otherwise(rest)
    return F.when((n > 3) & w.rlike(f"^[{X.ATTACHED}]"), inner).when((n > 3) & w.startswith("ה"), rest).otherwise(w)


def stem(w: Column) -> Column:
    """Without the first ending that leaves three letters."""
    out = None
    for e in X.ENDINGS:
        fits = w.endswith(e) & (F.length(w) - len(e) >= 3)
        cut = F.substring(w, F.lit(1), F.length(w) - len(e))
        out = F.when(fits, cut) if out is None else out.when(fits, cut)
    return out.otherwise(w)


def stem_literal(w: str) -> str:
    return next((w[: -len(e)] for e in X.ENDINGS if w.endswith(e) and len(w) - len(e) >= 3), w)


STOP = sorted(set(X.STOPWORDS) | {stem_literal(w) for w in X.STOPWORDS})


def significant(matchable: Column) -> Column:
    """Stems of the words that carry meaning, in order, of a text in matchable form."""
    words = F.transform(F.split(F.coalesce(matchable, F.lit("")), " "), lambda w: stem(without_attached(w)))
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(STOP))


def token_set(matchable: Column) -> Column:
    return F.array_sort(F.array_distinct(significant(matchable)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 if either is empty."""
    n = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - n
    return F.when((F.size(a) > 0) & (F.size(b) > 0), n / union).otherwise(0.0)


def overlap(a: Column, b: Column, without: Column) -> Column:
    """Tokens that both sets have, other than those of `without`."""
    return F.array_except(F.array_intersect(a, b), without)


def blocking_key(cleaned: Column, tokens: Column, place: Column) -> Column:
    """A key under which reports of one event may meet: of the place, or else of the three longest tokens (ties in
    alphabetical order), or else of the text's start."""
    longest = F.slice(
        F.array_sort(tokens, lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0)), 1, 3
    )
    start = F.coalesce(F.nullif(F.substring(cleaned, 1, 60), F.lit("")), F.lit("empty"))
    seed = (
        F.when(F.coalesce(place, F.lit("")) != "", F.concat(F.lit("loc:"), place))
        .when(F.size(tokens) > 0, F.concat(F.lit("tok:"), F.array_join(F.array_sort(longest), "|")))
        .otherwise(start)
    )
    return F.substring(F.sha1(seed), 1, 20)


def near_line(note: Column, base_lines: Column, threshold: float = 0.30) -> Column:
    """Whether any of the lines (token sets) is as similar to the note (a token set) as the threshold."""
    return F.exists(base_lines, lambda line: jaccard(note, line) >= threshold)

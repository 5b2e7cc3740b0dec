"""Problem 5: freely entered values mapped to the closest entry of a reference list.

The join is a prefix-filter set-similarity join. A form (of a value, or of a list entry) is the set of its padded
character pairs, ordered by global rarity, rarest first. The similarity wanted grows with the length: of the m pairs of the
longer form at most DIFFER may be missing in the other one, a Jaccard of at least (m - 3) / (n + 3) for a partner of n pairs;
a wrong, missing or added letter or two swapped ones never change more. Such forms share a pair within their first
DIFFER + 1 pairs, so only those are joined, whatever the length; length and positional filters cut further, and the Jaccard
of what is left is verified exactly. Of the verified candidates of a value the one with the largest Jaccard is kept, after an
exact check that really at most one letter is wrong, missing, added or swapped; a value without a candidate means no entry.

Only distinct values are joined, so a value that fills a third of the rows costs as much as one that stands there once.
A value's forms are its runs of up to as many words as the longest entry has (three at least), with and without the one or two letters that Hebrew attaches to a
word's start. A form that is only part of an entry's name counts if that part belongs to one entry and if no word of
another kind of place stands beside it.

Null and blank values stay unmapped and are not reported. Candidates of equal Jaccard: a whole name before a part of one, the
longer one first, then the smaller place_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .canonical import canonical_text, unstable
from .common import kept

#: How many pairs of the longer form may be missing in the other one.
DIFFER = 3
# Letters that Hebrew attaches to the start of a word; letters that are written once or twice.
ATTACHED = "בלמשוהכ"
DOUBLED = "(י|ו)\\1+"
MOST_WORDS = 3


@F.pandas_udf(StringType())
def _canonical(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([canonical_text(t) for t in texts], dtype=object)


def plain(c: Column) -> Column:
    """Lower case, words of letters and digits parted by one blank."""
    c = F.regexp_replace(F.lower(c), r"\p{M}+", "")
    return F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))


def once(c: Column) -> Column:
    """Letters that are written once or twice, once."""
    return F.regexp_replace(c, DOUBLED, "$1")


def spellings(head: Column, tail: Column) -> Column:
    """The two parts as one form, as they are and with letters written once: in both parts, or in the first."""
    return F.array_distinct(F.array(F.concat(head, tail), once(F.concat(head, tail)), F.concat(once(head), tail)))


def pairs_of(form: Column) -> Column:
    padded = F.concat(F.lit("^"), form, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(form) + 1), lambda i: F.substring(padded, i, F.lit(2))))


def _ordered(forms: DataFrame, rarity: DataFrame) -> DataFrame:
    """(form, n, tokens): the pairs of each form, rarest first."""
    tokens = forms.select("form", F.explode(pairs_of(F.col("form"))).alias("token")).join(rarity, "token")
    made = tokens.groupBy("form").agg(F.sort_array(F.collect_list(F.struct("rows", "token"))).alias("t"))
    return made.select("form", F.transform("t", lambda x: x["token"]).alias("tokens"), F.size("t").alias("n"))


def similar_forms(left: DataFrame, right: DataFrame, differ: int = DIFFER) -> DataFrame:
    """(form, entry, jaccard) of all pairs of a left and a right form that differ in no more than `differ` pairs of the longer one
    and have one in common. Both sides: (form), distinct, not empty."""
    every = left.select("form").unionByName(right.select("form"))
    rarity = every.select(F.explode(pairs_of(F.col("form"))).alias("token")).groupBy("token").agg(F.count("*").alias("rows"))

    def prefixes(df: DataFrame, name: str) -> DataFrame:
        df = _ordered(df, rarity).withColumn("p", F.slice("tokens", 1, differ + 1))
        return df.select(F.col("form").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"t_{name}"), F.posexplode("p").alias(f"i_{name}", "token"))

    a, b = prefixes(left, "form"), prefixes(right, "entry")
    least = F.greatest(F.greatest("n_form", "n_entry") - differ, F.lit(1))
    # The first common pair, in rarity order, has at most the pairs after it in common beside itself.
    near = (F.abs(F.col("n_form") - F.col("n_entry")) <= differ) & (F.least(F.col("n_form") - F.col("i_form"), F.col("n_entry") - F.col("i_entry")) >= least)
    met = a.join(b, "token").where(near).select("form", "entry", "t_form", "t_entry").dropDuplicates(["form", "entry"])
    shared, m, n = F.size(F.array_intersect("t_form", "t_entry")), F.greatest(F.size("t_form"), F.size("t_entry")), F.least(F.size("t_form"), F.size("t_entry"))
    jaccard = shared / (m + n - shared)
    return met.select("form", "entry", jaccard.alias("jaccard"), (F.greatest(m - differ, F.lit(1)) / F.least(n + differ, m + n - 1)).alias("least")).where("jaccard >= least - 1e-9").drop("least")


def entry_forms(places: DataFrame, aliases: DataFrame) -> DataFrame:
    """(entry, place_id, whole, exact): the forms of the list's entries. whole: the full name; else a part that one entry
    alone has, or a name of one word, which a word of some kind beside it makes another place. exact: no edit is allowed."""
    names = places.select("place_id", F.explode(F.array("name", "name_en")).alias("n")).select("place_id", F.split(plain(F.col("n")), " ").alias("w")).where("w[0] <> ''")
    first, rest, several = F.col("w")[0], F.array_join(F.slice("w", F.lit(2), F.size("w")), ""), F.size("w") > 1
    none = F.lit("")
    full = names.select("place_id", F.explode(spellings(first, rest)).alias("entry"), several.alias("whole"), F.lit(False).alias("exact"), F.lit(0).alias("rank"))
    known = aliases.select("place_id", F.split(plain(F.col("alias")), " ").alias("w")).where("w[0] <> ''")
    known = known.select("place_id", F.explode(spellings(first, rest)).alias("entry"), several.alias("whole"), F.lit(False).alias("exact"), F.lit(0).alias("rank"))
    parts = names.where(several)
    short = parts.select("place_id", F.explode(spellings(rest, none)).alias("entry"), F.lit(False).alias("whole"), F.lit(False).alias("exact"), F.lit(1).alias("rank"))
    initials = parts.select("place_id", F.explode(spellings(F.substring(first, 1, 1), rest)).alias("entry"), F.lit(True).alias("whole"), F.lit(True).alias("exact"), F.lit(1).alias("rank"))
    every = full.unionByName(known).unionByName(short).unionByName(initials)
    own = every.withColumn("best", F.min("rank").over(W.partitionBy("entry"))).where("rank = best")
    made = own.groupBy("entry").agg(F.min("place_id").alias("place_id"), F.max("place_id").alias("other"), F.max("whole").alias("whole"), F.min("exact").alias("exact"))
    return made.where("place_id = other").drop("other")


def kind_words(places: DataFrame) -> DataFrame:
    """(kind): first words of names of several words, as in `plain`."""
    names = places.select(F.explode(F.array("name", "name_en")).alias("n")).select(F.split(plain(F.col("n")), " ").alias("w")).where(F.size("w") > 1)
    return names.select(once(F.col("w")[0]).alias("kind")).distinct()


def _attached(word: Column) -> Column:
    """The word, and without one or two attached letters."""
    one = F.when(word.rlike(f"^[{ATTACHED}][\\u05d0-\\u05ea]{{2,}}"), F.substring(word, F.lit(2), F.length(word)))
    two = F.when(word.rlike(f"^[{ATTACHED}]{{2}}[\\u05d0-\\u05ea]{{2,}}"), F.substring(word, F.lit(3), F.length(word)))
    return F.array_compact(F.array(word, one, two))


def most_words(places: DataFrame, aliases: DataFrame) -> int:
    """The words of the list's longest name or alias, MOST_WORDS at least: entered names may hold blanks too many."""
    names = places.select(F.explode(F.array("name", "name_en")).alias("n")).unionByName(aliases.select(F.col("alias").alias("n")))
    return max(MOST_WORDS, names.agg(F.max(F.size(F.split(plain(F.col("n")), " "))).alias("m")).first().m or 0)


def value_forms(values: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """(value, form, beside): the forms of each distinct value; beside: its other words, with and without attached letters."""
    clean = values.select("value", F.coalesce(_canonical(F.when(unstable(F.col("value")), F.col("value"))), F.col("value")).alias("c"))
    turned = F.when(F.col("c").rlike(r"\(.*\)"), F.regexp_replace("c", r"^(.*?)\((.*?)\)(.*)$", "$2 $1 $3"))
    words = clean.select("value", F.explode(F.array_distinct(F.array_compact(F.array(plain(F.col("c")), plain(turned))))).alias("p")).where("p <> ''")
    w = words.select("value", F.split("p", " ").alias("w"))
    spans = w.select("value", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("a")).select("value", "w", "a", F.explode(F.sequence(F.lit(1), F.least(F.lit(most), F.size("w") - F.col("a") + 1))).alias("n"))
    rest = F.concat(F.slice("w", 1, F.col("a") - 1), F.slice("w", F.col("a") + F.col("n"), F.size("w")))
    spans = spans.select("value", F.slice("w", F.col("a"), F.col("n")).alias("s"), F.transform(F.flatten(F.transform(rest, _attached)), once).alias("beside"))
    tail = F.array_join(F.slice("s", F.lit(2), F.size("s")), "")
    heads = spans.select("value", "beside", F.explode(_attached(F.col("s")[0])).alias("head"), tail.alias("tail"))
    return heads.select("value", "beside", F.explode(spellings(F.col("head"), F.col("tail"))).alias("form")).where("length(form) >= 2").distinct()


def mapped(values: DataFrame, places: DataFrame, aliases: DataFrame, differ: int = DIFFER) -> DataFrame:
    """(value, place_id, jaccard): the closest entry of each distinct value, -1 if it means none. values: (value), distinct, not blank."""
    forms = kept(value_forms(values, most_words(places, aliases)))
    entries = entry_forms(places, aliases)
    close = similar_forms(forms.select("form").distinct(), entries.select(F.col("entry").alias("form")), differ)
    letters = lambda c: F.array_join(F.array_sort(F.split(c, "")), "")
    edits = F.levenshtein("form", "entry", 2)
    swapped = (edits == 2) & (F.length("form") == F.length("entry")) & (letters(F.col("form")) == letters(F.col("entry")))
    close = close.withColumn("edits", F.when(edits >= 0, F.when(edits < 2, edits).when(swapped, 1))).where("edits = 0 OR (edits = 1 AND length(entry) >= 5)")
    # Parts of a name with a word of some kind of place beside them mean another place; only such matches are asked.
    found = kept(forms.join(close, "form").join(entries, "entry").where("edits = 0 OR NOT exact").select("value", "beside", "entry", "place_id", "whole", "exact", "jaccard"))
    parts = found.where("NOT whole")
    other = parts.select("value", "beside", F.explode("beside").alias("kind")).join(kind_words(places), "kind", "left_semi").select("value", "beside").distinct()
    found = found.where("whole").unionByName(parts.join(other, ["value", "beside"], "left_anti").select(*found.columns))
    best = found.groupBy("value").agg(F.min(F.struct((-F.col("jaccard")).alias("j"), "exact", (~F.col("whole")).alias("part"), (-F.length("entry")).alias("l"), "place_id")).alias("b"))
    return values.join(best, "value", "left").select("value", F.coalesce(F.col("b.place_id"), F.lit(-1)).cast("int").alias("place_id"), (-F.col("b.j")).alias("jaccard"))

"""Places named in texts, by an equi-join with a gazetteer.

A name in a text may carry up to two attached letters and a definite article. In matchable form there is no punctuation,
so a match of such a name is a run of whole words; the join is on its first word with the attached letters taken off,
which is an equality, and the rest of the name is compared as an array. The longest name that a text has wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import clean, matchable, strip
from ..sources.shared import kept


def gazetteer(places: DataFrame, aliases: DataFrame) -> DataFrame:
    """(rank, name, core, tolerant, rest, latitude, longitude): names and aliases; the least rank is that of the longest, then as
    in the table. A kept table: names are cleaned once, not wherever the gazetteer is read.

    places: (place_id, name, latitude, longitude); aliases: (alias, place_id). Names without letters are left out.
    """
    names = places.select(F.lit(0).alias("kind"), "place_id", F.col("name").alias("term"), "name", "latitude", "longitude")
    other = aliases.join(places.select("place_id", "name", "latitude", "longitude"), "place_id").select(F.lit(1).alias("kind"), "place_id", F.col("alias").alias("term"), "name", "latitude", "longitude")
    terms = names.unionByName(other).withColumn("words", F.split(matchable(clean(F.col("term"))), " ")).where("words[0] <> ''")
    rank = F.struct((-F.length("term")).alias("length"), "kind", "place_id", "term")
    first = F.col("words")[0]
    core = F.when(first.startswith("ה") & (F.length(first) > 3), F.substring(first, F.lit(2), F.length(first))).otherwise(first)
    tolerant = (F.length(core) >= 4) | (F.size("words") > 1)
    return kept(terms.select(
        rank.alias("rank"), "name", F.when(tolerant, core).otherwise(first).alias("core"), tolerant.alias("tolerant"),
        F.slice("words", F.lit(2), F.size("words")).alias("rest"), "latitude", "longitude",
    ))


def _cores(word: Column) -> Column:
    """(core, bare) forms of a word: itself, and without attached letters."""
    cls = f"[{X.ATTACHED_TO_NAMES}]"
    off = lambda n: F.struct(F.substring(word, F.lit(n + 1), F.length(word)).alias("core"), F.lit(False).alias("bare"))
    return F.array_compact(
        F.array(
            F.struct(word.alias("core"), F.lit(True).alias("bare")),
            F.when(word.rlike(f"^{cls}."), off(1)),
            F.when(word.rlike(f"^{cls}{{2}}."), off(2)),
            F.when(word.rlike(f"^{cls}{{2}}ה."), off(3)),
        )
    )


def located(df: DataFrame, key: str, text: str, places: DataFrame, ambiguous: tuple[str, ...] = (), not_places: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(key, name, latitude, longitude) of each row with a place. text is in matchable form.

    ambiguous: names that are no places when they stand alone; not_places: forms that are no mention of a name. Only the
    first mention of a name in a text is looked at, as a veto skips the name, not the mention.
    """
    terms = gazetteer_checked(places)
    longest = terms.agg(F.max(F.size("rest"))).first()[0] or 0
    # Each word with as many words after it as the longest name needs; the text itself is not carried along.
    spots = F.transform("w", lambda word, i: F.struct(i.alias("at"), word.alias("word"), F.slice("w", i + 2, F.lit(longest)).alias("after")))
    words = df.select(key, F.split(text, " ").alias("w")).select(key, F.inline(spots)).where("word <> ''")
    cut = words.select(key, "at", "word", "after", F.explode(_cores(F.col("word"))).alias("c"))
    cut = cut.select(key, "at", "word", "after", F.col("c.core").alias("core"), F.col("c.bare").alias("bare"))
    fits = (F.col("bare") | F.col("tolerant")) & (F.slice(F.col("after"), F.lit(1), F.size("rest")) == F.col("rest"))
    met = cut.join(terms, "core").where(fits)
    form = F.array_join(F.concat(F.array("word"), "rest"), " ")
    first = met.groupBy(key, "rank").agg(F.min_by(F.struct(form.alias("form"), "name", "latitude", "longitude"), "at").alias("m")).select(key, "rank", "m.*")
    for name in ambiguous:
        first = first.where(~((F.col("name") == name) & F.col("form").rlike(f"^[{X.ATTACHED_TO_NAMES}]*{name}$")))
    for name, forms in (not_places or {}).items():
        first = first.where(~((F.col("name") == name) & F.col("form").isin(*forms)))
    return first.groupBy(key).agg(F.min_by(F.struct("name", "latitude", "longitude"), "rank").alias("m")).select(key, "m.*")


def gazetteer_checked(terms: DataFrame, most: int = 20_000) -> DataFrame:
    """Marked for broadcast if it is as small as gazetteers are; a larger one is joined as the planner sees fit."""
    return F.broadcast(terms) if terms.limit(most + 1).count() <= most else terms


def resolved(df: DataFrame, name: str, places: DataFrame, aliases: DataFrame) -> DataFrame:
    """df with place, latitude and longitude of a given name: by alias, else by name; an unknown name stays as it is, without coordinates."""
    known = aliases.join(places.select("place_id", F.col("name").alias("_by_alias")), "place_id").groupBy(F.col("alias").alias("_alias")).agg(F.min("_by_alias").alias("_by_alias"))
    at = places.groupBy(F.col("name").alias("place")).agg(F.min_by("latitude", "place_id").alias("latitude"), F.min_by("longitude", "place_id").alias("longitude"))
    out = df.withColumn("_given", strip(F.col(name))).join(known, F.col("_given") == F.col("_alias"), "left")
    return out.withColumn("place", F.coalesce("_by_alias", "_given")).drop("_given", "_alias", "_by_alias").join(at, "place", "left")

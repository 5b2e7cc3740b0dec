"""The pN_ queries: each takes (spark, sf_dir) and covers its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import canonical as _canonical
from . import encoding as _encoding
from . import lines as _lines
from . import mapping as _mapping
from . import mixing as _mixing
from . import near as _near
from . import quality as _quality
from . import survivors as _survivors
from . import truncation as _truncation
from .common import kept, table, usable_source
from .oracles import oracle_sql  # noqa: F401


# --- 1: best representative of each duplicate group
def p1_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors.survivors(table(spark, sf_dir, "reports"), table(spark, sf_dir, "sources"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors.surviving_ids(p1_survivors(spark, sf_dir))


# --- 2: lines repeated across one source's documents
def _keyed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source, keys) of each report with a usable source; keys are made before the rows stored twice are dropped, so that texts aren't shuffled."""
    reports = table(spark, sf_dir, "reports").where("id IS NOT NULL").select("id", "source_name", "content")
    return _lines.keyed(usable_source(reports, table(spark, sf_dir, "sources")).where("source IS NOT NULL"), "content").dropDuplicates(["id"])


def _blocks(docs: DataFrame) -> DataFrame:
    return kept(_lines.blocks(_lines.repeated_lines(docs), _lines.repeated_edges(docs)))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kept(_keyed_reports(spark, sf_dir))
    own = docs.join(_lines.marks_per_source(_blocks(docs)), "source")
    return own.select("id", F.posexplode(_lines.block_of(F.col("keys"), F.col("marks"))).alias("line_no", "block")).where("block IS NOT NULL").select("id", "line_no")


def p2_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, block, line, reports) of each line of a source's blocks, in the form in which lines are compared; a block is named by its first line."""
    sources = table(spark, sf_dir, "sources")
    docs = kept(_keyed_reports(spark, sf_dir))
    marks = _blocks(docs)
    reports = usable_source(table(spark, sf_dir, "reports").where("id IS NOT NULL").select("source_name", "content"), sources).where("source IS NOT NULL")
    own = reports.join(_lines.marks_per_source(marks), "source").select("source", "marks", F.arrays_zip(_lines.line_keys(F.col("content")).alias("line"), _lines.line_texts(F.col("content")).alias("text")).alias("z"))
    texts = own.select("source", F.inline(F.filter("z", lambda x: F.exists("marks", lambda m: m["line"] == x["line"])))).groupBy("source", "line").agg(F.min("text").alias("text"))
    named = marks.join(texts, ["source", "line"])
    first = named.groupBy("source", "block").agg(F.min("text").alias("name"))
    return named.join(first, ["source", "block"]).select("source", F.col("name").alias("block"), F.col("text").alias("line"), "reports")


def _source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kept(_keyed_reports(spark, sf_dir).select("source", "keys"))
    return _lines.per_source(_lines.repeated_lines(docs))


def _report_source(reports: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds `source`: the usable source_name, or else the name that source_id has."""
    by_id = sources.where("id IS NOT NULL").groupBy("id").agg(F.min("name").alias("id_name")).withColumnRenamed("id", "source_id")
    return usable_source(reports, sources).join(by_id, "source_id", "left").withColumn("source", F.coalesce("source", "id_name")).drop("id_name")


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, content) of each report, without the occurrences of its source's blocks."""
    reports = usable_source(table(spark, sf_dir, "reports").where("id IS NOT NULL").select("id", "source_name", "content"), table(spark, sf_dir, "sources"))
    marks = _lines.marks_per_source(_blocks(kept(_keyed_reports(spark, sf_dir))))
    return _lines.without_blocks(reports.join(marks, "source", "left"), "content").dropDuplicates(["id"])


# --- 3: text cut off by field limits
def _cut_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "sources")
    reports = table(spark, sf_dir, "reports").where("id IS NOT NULL").select("id", "content", "source_name", "source_id")
    keyed = kept(_lines.keyed(usable_source(reports, sources), "content").dropDuplicates(["id"]))
    own = _lines.per_source(_lines.repeated_lines(keyed.where("source IS NOT NULL")))
    docs = _report_source(reports.where("content IS NOT NULL"), sources).join(own, "source", "left").select(F.lit("reports").alias("tbl"), "id", F.col("content").alias("text"), "lines")
    lines = kept(_truncation.furniture(docs, _truncation.returning(keyed.select("id", "keys"))))
    excerpts = table(spark, sf_dir, "report_sources").where("id IS NOT NULL AND excerpt IS NOT NULL").select("id", "excerpt", "source_name", "source_id")
    both = docs.unionByName(_report_source(excerpts, sources).join(own, "source", "left").select(F.lit("report_sources").alias("tbl"), "id", F.col("excerpt").alias("text"), "lines"))
    known = _truncation.known_furniture(lines)
    return _truncation.cut_values(_truncation.without_furniture(both, "text", lines) if known is None else both, known)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_values(spark, sf_dir).where("cut").select("tbl", "id")


def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, source_id, values, cut, share) of each source; values without a message don't count."""
    names = [table(spark, sf_dir, t).select(F.lit(t).alias("tbl"), "id", "source_id").dropDuplicates(["id"]) for t in ("reports", "report_sources")]
    seen = _cut_values(spark, sf_dir).join(names[0].unionByName(names[1]), ["tbl", "id"])
    made = seen.groupBy("tbl", "source_id").agg(F.count("*").alias("values"), F.count_if("cut").alias("cut"))
    return made.withColumn("share", F.col("cut") / F.col("values"))


# --- 4: visually identical text
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical.look_alike_cases(table(spark, sf_dir, "reports"), "id", ["title", "content"])


def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, title, content) of each report in the consistent form."""
    return _canonical.canonical(table(spark, sf_dir, "reports").select("id", "title", "content"), ["title", "content"])


# --- 5: free values mapped to the list of places
def p5_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, place_id, jaccard) of each distinct location_name that is not blank and no name of the list as it stands."""
    places = table(spark, sf_dir, "places")
    values = table(spark, sf_dir, "reports").select(F.col("location_name").alias("value")).where(F.col("value").rlike(r"(?U)\S")).distinct()
    values = kept(values.join(places.select(F.col("name").alias("value")), "value", "left_anti"))
    return _mapping.mapped(values, places, table(spark, sf_dir, "place_aliases"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = table(spark, sf_dir, "reports").select("id", F.col("location_name").alias("value")).where("id IS NOT NULL AND value IS NOT NULL").dropDuplicates(["id"])
    return reports.join(p5_values(spark, sf_dir).select("value", "place_id"), "value").select("id", "place_id")


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, reports): values that mean no place of the list, and in how many reports they stand."""
    return p5_found(spark, sf_dir).where("place_id = -1").join(table(spark, sf_dir, "reports").select("id", F.col("location_name").alias("value")).dropDuplicates(["id"]), "id").groupBy("value").agg(F.count("*").alias("reports"))


# --- 6: near-duplicate records
def _word_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "sources")
    reports = table(spark, sf_dir, "reports").where("id IS NOT NULL").select("id", "title", "content", "source_name", "source_id")
    docs = _report_source(reports, sources).join(_source_lines(spark, sf_dir), "source", "left")
    corpus = table(spark, sf_dir, "reports").select(F.concat_ws("\n", "title", "content").alias("text"))
    forms = kept(_canonical.usual_forms(corpus, ["text"]))
    usual = _canonical.bounded(forms)
    if usual is not None:
        return _near.word_sets(docs, usual)
    docs = docs.select("id", F.concat_ws("\n", "title", _lines.without_lines(F.col("content"), F.col("lines"))).alias("text"))
    return _canonical.canonical(docs, ["text"], corpus=corpus).select("id", _near.words_of(F.col("text")).alias("words"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, classes = _near.word_classes(_word_sets(spark, sf_dir))
    return _near.expanded(members, _near.similar_classes(classes))


def p6_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, class): which reports have the same words; with p6_links the whole result, copies not expanded into pairs."""
    return _near.word_classes(_word_sets(spark, sf_dir))[0]


def p6_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a, b, jaccard): pairs of classes of p6_members and their similarity."""
    return _near.similar_classes(_near.word_classes(_word_sets(spark, sf_dir))[1])


# --- 7: token ids
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoding.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


# --- 8: sources mixed to target shares
def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text").join(targets.select("source").distinct(), "source", "left_semi")
    sizes = kept(_encoding.token_counts(docs, "doc_id", "text", "source"))
    tokens = sizes.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.count("*").alias("documents"))
    plan = kept(_mixing.scales(targets, tokens))
    return kept(_mixing.select_documents(sizes, plan)), plan


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mix, source, doc_id, tokens, repeats) of each document of each mix."""
    return _mix(spark, sf_dir)[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(mix, source, target_share, share, tokens, documents, most_repeats) of each source of each mix."""
    return _mixing.reached(*_mix(spark, sf_dir))


# --- 9: text quality statistics
def p9_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, words, word_length, symbol_ratio, lines_ended, common_share, and the other statistics) of each document."""
    made = _quality.measured(table(spark, sf_dir, "documents"))
    more = [F.get("f", F.lit(i)).alias(n) for i, n in enumerate(_quality.STATISTICS) if n not in ("common", "symbols", "word_length")]
    return made.select("doc_id", "words", "word_length", "symbol_ratio", "lines_ended", "common_share", *more)


def p9_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, kind, prose) of each document with a text that is not blank."""
    features = kept(_quality.measured(table(spark, sf_dir, "documents")).where("f IS NOT NULL").select("doc_id", "f"))
    model = _quality.fitted(features, _quality.examples(features, table(spark, sf_dir, "doc_labels")))
    if model is None:
        return features.select("doc_id", F.lit("prose").alias("kind"), F.lit(1.0).alias("prose"))
    return _quality.classified(features, model)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_kinds(spark, sf_dir).where("kind <> 'prose'").select("doc_id")


def queries() -> dict:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit() and callable(v)}

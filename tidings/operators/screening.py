"""An ordered cascade of filters that says why it rejects.

Every test is a Column on one matchable text; the cascade is one coalesce, so the first failing test gives the reason and
later tests aren't evaluated. Words come from a RulePack.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.language import first_term, has_any, in_language, in_other_script, term_in
from ..functions.lexicon import Reject, RulePack
from ..functions.text import clean, keyword_list, matchable, strip, summary

VERDICT = "relevant boolean, reason string, category string, severity string, summary string"


def without_ignored(m: Column, pack: RulePack) -> Column:
    for phrase in pack.ignored:
        m = F.replace(m, F.lit(phrase), F.lit(""))
    return m


def blocked(m: Column, pack: RulePack) -> Column:
    """The first category with a word in the text. An ambiguous one is passed over in a security context outside its exceptions."""
    m = without_ignored(m, pack)
    saved = has_any(m, pack.context) & ~has_any(m, pack.no_context)
    hits = [F.when(has_any(m, words) & (~saved if name in pack.ambiguous else F.lit(True)), F.lit(name)) for name, words in pack.blocks.items()]
    return F.coalesce(*hits, F.lit(None).cast("string"))


def rejected(m: Column, rule: Reject, pack: RulePack, place: Column | None = None) -> Column:
    hit = F.lit(True)
    for i, words in enumerate(rule.needs):
        one = has_any(m, words)
        hit = hit & (one | m.rlike(rule.pattern) if rule.pattern and i == len(rule.needs) - 1 else one)
    hit = hit & ~has_any(without_ignored(m, pack), rule.unless)
    return hit & (place.isNull() if place is not None else F.lit(True)) if rule.no_place else hit


def breaking(m: Column, pack: RulePack) -> tuple[Column, Column]:
    """(is it happening now, the word that says otherwise). A live word overrides words of the past and of statements."""
    live = F.lit(False)
    for w in pack.live:
        live = live | term_in(m, w)
    past, statement = first_term(m, pack.past), first_term(m, pack.statement)
    why = F.when(~live, F.coalesce(F.concat(F.lit("past: "), past), F.concat(F.lit("statement: "), statement)))
    return why.isNull(), why


def relevance(m: Column, pack: RulePack) -> tuple[Column, Column]:
    """(relevant, reason): a closing notice; a strong sign of impact; a weak one without a sign of activity elsewhere."""
    weak = set(pack.weak)
    strong = has_any(m, [w for w in pack.impact if w not in weak])
    some, outbound = has_any(m, pack.impact), has_any(m, pack.outbound)
    reason = F.when(has_any(m, pack.resolution), F.lit("closing")).when(strong | (some & ~outbound), F.lit("impact")).when(outbound, F.lit("outbound")).otherwise(F.lit("no sign"))
    return reason.isin("closing", "impact"), reason


def invented(summary_m: Column, source_m: Column, pack: RulePack) -> Column:
    """A summary that tells of casualties by a word that its source does not have."""
    hit = F.lit(False)
    for w in pack.casualties:
        hit = hit | (has_any(summary_m, [w]) & ~has_any(source_m, [w]))
    return hit


def rules_from(table: DataFrame, pack: RulePack) -> RulePack:
    """The pack with the active rules of a table (name, rule_type, keywords text, is_active); read anew for each batch."""
    from dataclasses import replace

    rows = table.where("is_active").select(F.coalesce(F.nullif(strip(F.col("name")), F.lit("")), F.lit("custom")).alias("name"), F.lower(strip(F.coalesce("rule_type", F.lit("suppress")))).alias("kind"), keyword_list(F.col("keywords")).alias("words"))
    blocks, promote, review = {k: list(v) for k, v in pack.blocks.items()}, list(pack.promote), list(pack.review)
    for r in rows.where(F.size("words") > 0).collect():  # hand-written rules: as many as people write
        if r.kind == "promote":
            promote += r.words
        elif r.kind == "review":
            review += r.words
        else:
            blocks.setdefault(r.name, []).extend(r.words)
    return replace(pack, blocks=blocks, promote=tuple(promote), review=tuple(review))


def rule_counts(pack: RulePack) -> dict[str, int]:
    """How many words a pack's rules have, by kind."""
    return {"suppress": sum(map(len, pack.blocks.values())), "promote": len(pack.promote), "review": len(pack.review)}


def judge_chain(*judges: Callable[[str], dict | None]) -> Callable[[str], dict | None]:
    """The judges in order: the first that gives a verdict counts, one that raises counts as silent."""

    def verdict(text: str) -> dict | None:
        for judge in judges:
            try:
                if (found := judge(text)) is not None:
                    return found
            except Exception:  # noqa: BLE001, S112  a judge that fails must not stop the others
                continue
        return None

    return verdict


def marked(raw: Column, fields: str, marks: dict[str, Column]) -> Column:
    """The struct (of type `fields`) with the marks that are not null in place of its own fields; the others stay. A null struct
    becomes one if there is a mark."""
    some = F.coalesce(raw, F.when(F.coalesce(*[m.cast("string") for m in marks.values()]).isNotNull(), F.from_json(F.lit("{}"), fields))) if marks else raw
    for name, mark in marks.items():
        some = some.withField(name, F.coalesce(mark, some[name]))
    return some


def screened(
    df: DataFrame, pack: RulePack, place: str | None = None, verdicts: Callable[[str], dict | None] | None = None, official: tuple[str, ...] = (), raw: str | None = None
) -> DataFrame:
    """df (title, content, severity, status, ...) with keep, reason, promoted, filter, and status, content and severity as screened.

    verdicts: an optional judge of a text, called once a row through an iterator of batches; None of it means no judgement.
    official: kinds of source (source_type, in any case) whose items pass as they are. raw: a struct column that gets the marks
    filter, promoted, category and reason, of those fields that it has.
    """
    both = F.concat_ws(". ", F.coalesce("title", F.lit("")), F.coalesce("content", F.lit("")))
    free = F.coalesce(F.lower("source_type").isin(*official), F.lit(False)) if official else F.lit(False)
    # What screening reads of a row; an official item's columns are put back at the end.
    own = [c for c in ("content", "severity", "status") if official]
    df = df.withColumn("_free", free).withColumns({f"_own_{c}": F.col(c) for c in own})
    df = df.withColumn("_t", both).withColumn("_m", matchable(clean(both)))
    t, m = F.col("_t"), F.col("_m")
    where = F.col(place) if place else None
    is_live, why = breaking(m, pack)
    good, reason = relevance(m, pack)
    reject = F.coalesce(
        F.when(~in_language(t, pack), F.lit("language")),
        F.when(in_other_script(t, pack), F.lit("other script")),
        F.concat(F.lit("blocked: "), blocked(m, pack)),
        *[F.when(rejected(m, r, pack, where), F.lit(r.reason)) for r in pack.rejects],
        F.when(~is_live, why),
    )
    promoted = has_any(m, pack.promote) & (reason != "outbound")
    df = df.withColumn("_reject", reject).withColumn("_good", good).withColumn("_why", reason).withColumn("promoted", promoted)
    verdict = F.lit(None).cast(f"struct<{VERDICT.replace(' ', ':')}>".replace(",:", ","))
    if verdicts is not None:
        verdict = _judge(verdicts)(F.when(F.col("_reject").isNull() & ~F.col("_free"), t))
    df = df.withColumn("_v", verdict)
    v = F.col("_v")
    text_of = lambda c: matchable(clean(F.coalesce(c, F.lit(""))))
    fake = F.coalesce(invented(text_of(v["summary"]), m, pack), F.lit(False)) if verdicts is not None else F.lit(False)
    use = v["relevant"].isNotNull() & ~fake
    meta = has_any(text_of(F.concat_ws(" ", v["reason"], v["summary"])), pack.meta) if verdicts is not None else F.lit(False)
    keep = F.col("_reject").isNull() & F.when(use, v["relevant"] | (F.col("promoted") & ~meta)).otherwise(F.col("_good") | F.col("promoted"))
    final = summary(F.when(use, F.coalesce(F.nullif(v["summary"], F.lit("")), F.col("content"))).otherwise(F.col("content")))
    out = (
        df.withColumn("keep", F.coalesce(keep, F.lit(False)))
        .withColumn("reason", F.coalesce("_reject", F.when(use, v["reason"]), F.col("_why")))
        .withColumn("status", F.when(has_any(m, pack.review) | (fake & F.col("keep")), F.lit("reviewing")).otherwise(F.col("status")))
        .withColumn("filter", F.when(F.col("_reject").isNotNull(), F.lit("rule")).when(use, F.lit("judge")).when(F.lit(verdicts is not None), F.lit("fallback")).otherwise(F.lit("heuristic")))
        .withColumn("content", F.when(F.col("keep") & (final != ""), final).otherwise(F.col("content")))
        .withColumn("severity", F.when(use & v["severity"].isin("low", "medium", "high", "critical"), v["severity"]).otherwise(F.col("severity")))
    )
    if official:
        as_is = {"keep": F.lit(True), "reason": F.lit("official"), "promoted": F.lit(False), "filter": F.lit("none")} | {c: F.col(f"_own_{c}") for c in own}
        out = out.withColumns({c: F.when(F.col("_free"), v).otherwise(F.col(c)) for c, v in as_is.items()})
    if raw is not None:
        marks = {"filter": F.when(F.col("keep") & ~F.col("_free"), F.col("filter")), "promoted": F.when(F.col("keep") & F.col("promoted"), F.lit(True)), "category": F.when(use & F.col("keep"), v["category"]), "reason": F.when(use & F.col("keep"), v["reason"])}
        kind = df.schema[raw].dataType
        out = out.withColumn(raw, marked(F.col(raw), kind.simpleString(), {k: m for k, m in marks.items() if k in kind.fieldNames()}))
    return out.drop("_t", "_m", "_reject", "_good", "_why", "_v", "_free", *[f"_own_{c}" for c in own])


def _judge(verdicts: Callable[[str], dict | None]):
    @F.pandas_udf(VERDICT)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [x.split(" ")[0] for x in VERDICT.split(", ")]
        for texts in parts:
            made = [verdicts(t) if t is not None else None for t in texts]
            yield pd.DataFrame([{n: (r or {}).get(n) for n in names} for r in made], columns=names)

    return run.asNondeterministic()

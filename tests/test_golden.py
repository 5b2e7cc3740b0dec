"""Fixed cases of real messages: texts and what must come of them."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidings.functions import lexicon, text, tokens
from tidings.operators import places, saving, severity

G = json.loads((Path(__file__).parent / "golden.json").read_text(encoding="utf-8"))


def column(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", make(F.col("t")).alias("x"))
    return [r.x for r in df.orderBy("i").collect()]


def test_places(spark):
    rows = [(i, name, float(i), float(i)) for i, (name, _) in enumerate(G["geo_places"])]
    other = [(a, i) for i, (_, aliases) in enumerate(G["geo_places"]) for a in aliases]
    terms = places.gazetteer(spark.createDataFrame(rows, "place_id int, name string, latitude double, longitude double"), spark.createDataFrame(other, "alias string, place_id int"))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(G["geo"])], "i int, t string").withColumn("m", text.matchable(text.clean(F.col("t"))))
    got = {r.i: r.name for r in places.located(df, "i", "m", terms, ambiguous=tuple(G["geo_ambiguous"])).collect()}
    assert [got.get(i) for i in range(len(G["geo"]))] == [name for _, name in G["geo"]]


def test_severities(spark):
    assert column(spark, [t for t, _ in G["severity"]], lambda c: severity.severity(text.matchable(text.clean(c)))) == [s for _, s in G["severity"]]


def test_merging():
    score = lambda a, b: saving.jaccard(saving.tokens_of(a), saving.tokens_of(b))
    same, other = [score(G["merge_base"], t) for t in G["same"]], [score(G["merge_base"], t) for t in G["other"]]
    assert min(same) >= saving.NEAR > max(other) and min(same) - max(other) > 0.05
    for a, b, want in G["pairs"]:
        assert (score(a, b) >= 0.35) == want


def test_overlaps(spark):
    cases = G["overlap"] + [[G["merge_base"], G["same"][0], "קריית שמונה", True], [G["merge_base"], G["other"][0], "קריית שמונה", False], [G["merge_base"], G["other"][1], "קריית שמונה", False]]
    df = spark.createDataFrame([(i, a, b, p) for i, (a, b, p, _) in enumerate(cases)], "i int, a string, b string, p string")
    sets = [tokens.token_set(text.matchable(text.clean(F.col(c)))) for c in "abp"]
    got = [r.n > 0 for r in df.select("i", F.size(tokens.overlap(*sets)).alias("n")).orderBy("i").collect()]
    assert got == [w for *_, w in cases]
    assert [bool((saving.tokens_of(a) & saving.tokens_of(b)) - saving.tokens_of(p)) for a, b, p, _ in cases] == got


def test_cleaning(spark):
    got = column(spark, [t for t, _ in G["cleaned_without"]], text.clean)
    assert all(gone not in t for t, (_, gone) in zip(got, G["cleaned_without"]))
    assert column(spark, [t for t, _ in G["cleaned"]], text.clean) == [t for _, t in G["cleaned"]]


def test_quotes():
    assert all(text.matchable_literal(a) == text.matchable_literal(b) for a, b in G["quotes"])


def test_signs_only_spare_work(monkeypatch):
    """Each pattern is run only on texts with its sign; running all of them changes nothing."""
    r = random.Random(4)
    pieces = [*lexicon.SIGNS, "|", " ", " ", "\n", "*", "(12)", "12", "(1/2/2026)", "12:30: ", "--", "'", "x", "ידיעות", "ביו\"ש בוואצאפ:", "בווטסאפ:", "55", "אין תגובות", "3 תגובות", "https://a.b ", "🚨", ">", "!"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 9))) for _ in range(4000)]
    some = [text.clean_literal(t) for t in texts]
    monkeypatch.setattr(text, "_SIGNATURES", [("", p) for _, p in text._SIGNATURES])
    assert [text.clean_literal(t) for t in texts] == some and len(lexicon.SIGNS) == len(lexicon.BOILERPLATE)


@pytest.mark.parametrize("odd", [None, "", " \n ", "א" * 100_000, "\ud83d".encode("utf-16", "surrogatepass").decode("utf-16", "replace")])
def test_odd_texts(spark, odd):
    assert column(spark, [odd], text.clean)[0] == text.clean_literal(odd or "")

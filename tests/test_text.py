from pyspark.sql import functions as F

from tidings.functions import language, text, tokens
from tidings.functions.lexicon import RulePack


def one(spark, value, *columns):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(*[c.alias(str(i)) for i, c in enumerate(columns)]).first()


def cleaned(spark, value):
    return one(spark, value, text.clean(F.col("t")))[0]


def test_cleaning_takes_off_what_channels_add(spark):
    assert cleaned(spark, "אזעקות בצפון 🚨 https://t.me/x @name #tag") == "אזעקות בצפון"
    assert cleaned(spark, "ירי בגבול\nלהצטרפות לערוץ לחצו כאן") == "ירי בגבול"
    assert cleaned(spark, "סיום אירוע (19/09/2026 19:35) הסתיים") == "סיום אירוע - הסתיים"
    # The signature ends the line only once the link behind it is gone.
    assert cleaned(spark, "דיווח. חדשות 55 שומרון בווטסאפ: בטלגרם: t.me/x") == "דיווח."
    assert cleaned(spark, "שָׁלוֹם") == "שלום"
    assert cleaned(spark, "５ ﬁ​") == "5 fi"
    assert cleaned(spark, None) == "" and cleaned(spark, "") == "" and cleaned(spark, " \n ") == ""


def test_both_kinds_of_abbreviation_marks_match(spark):
    m = text.matchable(text.clean(F.col("t")))
    assert one(spark, 'צה"ל', m)[0] == one(spark, "צה״ל", m)[0] == text.matchable_literal("צה״ל") == "צה ל"


def test_column_and_literal_forms_agree(spark):
    for t in ("ארה״ב, בדרך (5 שניות) #x", "A_b-C  d", "١٢ Ünï ﬀ", "הצטרפו לערוץ\nטקסט"):
        assert one(spark, t, text.matchable(text.clean(F.col("t"))))[0] == text.matchable_literal(t)


def test_titles(spark):
    title = text.title(F.col("t"))
    assert one(spark, "ראשון. שני.", title)[0] == "ראשון."
    assert one(spark, "", title)[0] == "דיווח ללא כותרת"
    long = one(spark, "מילה " * 40, title)[0]
    assert len(long) <= 91 and long.endswith("…")


def test_summaries_keep_whole_sentences(spark):
    s = text.summary(F.col("t"), 20)
    assert one(spark, "One two. Three four. Five six seven.", s)[0] == "One two. Three four."[:20]
    assert one(spark, "short", s)[0] == "short"
    assert one(spark, "A sentence much too long for it here.", s)[0].endswith("…")
    # Once a sentence doesn't fit, later ones are not taken although they would.
    assert one(spark, "One. A very very long one here. X.", s)[0] == "One."


def test_times(spark):
    row = one(spark, "2026-01-02T03:04:05Z", text.time_of(F.col("t")), text.local_time(text.time_of(F.col("t"))))
    assert row[0].hour == 3 and row[1] == "05:04:05"
    assert one(spark, "2026-07-02T03:04:05Z", text.local_time(text.time_of(F.col("t"))))[0] == "06:04:05"
    assert one(spark, "yesterday", text.time_of(F.col("t")))[0] is None


def test_replies(spark):
    reply = text.reply_object(F.col("t"), "a int")
    assert one(spark, '```json\n{"a": 1}\n```', reply)[0].a == 1
    assert one(spark, 'so: {"a": 2} ok', reply)[0].a == 2
    assert one(spark, "none", reply)[0] is None


def test_channel_names(spark):
    h = text.channel_handle(F.lit(None).cast("string"), F.col("t"))
    for given in ("https://t.me/s/abc?x=1", "t.me/abc/12", "@abc", "abc"):
        assert one(spark, given, h)[0] == "abc"
    assert one(spark, "", h)[0] is None


def test_tokens(spark):
    t = tokens.significant(F.split(F.col("t"), "x")[0])
    assert one(spark, "בקריית אזעקות של", t)[0] == ["קריי", "אזעק"]
    a, b = F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))
    assert one(spark, "", tokens.jaccard(a, b), tokens.jaccard(a, F.array().cast("array<string>")))[:] == (0.5, 0.0)


def test_blocking_keys_do_not_depend_on_order(spark):
    key = lambda c: tokens.blocking_key(c, tokens.token_set(c), F.lit(None))
    assert one(spark, "alpha bravo charlie", key(F.col("t")))[0] == one(spark, "charlie alpha bravo", key(F.col("t")))[0]
    assert len(one(spark, "", key(F.col("t")))[0]) == 20


def test_language(spark):
    pack = RulePack()
    both = language.in_language(F.col("t"), pack), language.in_other_script(F.col("t"), pack)
    assert one(spark, "ירי לעבר כוחותינו בגבול", *both)[:] == (True, False)
    assert one(spark, "Only one name: תל אביב in an English text", *both)[:] == (False, False)
    assert one(spark, "خبر عاجل הודעה קצרה מאוד", *both)[1]
    assert one(spark, None, *both)[:] == (False, False)


def test_short_terms_stand_alone(spark):
    assert one(spark, "ab cd", language.term_in(F.col("t"), "cd"), language.term_in(F.col("t"), "b"))[:] == (True, False)

"""Input and expected output of the row functions."""

import difflib

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import language as G
from corpusloom.functions import predicates as P
from corpusloom.functions import text as T
from corpusloom.functions import udfs
from corpusloom.operators import intervals


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def lit(x):
    return F.lit(x)


@pytest.mark.parametrize(
    ("ru", "en", "reason"),
    [
        ("Ѓде моя старая шапка, скажи?", "Where is my old hat, tell me?", "mojibake"),
        ("ƒорогая, иди скорее домой", "Dear, come home at once", "mojibake"),
        ("О, о-о-о.", "Oh, oh, oh.", "interjection"),
        ("Хе-хе-хе.", "Heh heh heh.", "interjection"),
        ("Перевод: Анна Иванова", "Translated by Anna", "credits"),
        ("Да", "Yes", "length"),
        ("Он ушёл домой", "He left and went home a long time ago with all of his friends", "len_ratio"),
        ("hello there my friend", "hello there my friend", "ru_script"),
        ("Привет, мой старый друг", "Привет, мой старый друг", "en_script"),
        ("", "x", "empty"),
        ("Рынок открыт 7 марта, заходите", "The señor opens his market on March 7, come in", None),
        ("Ну ты и даёшь, приятель", "You are something, my friend", None),
    ],
)
def test_pair_reason(spark, ru, en, reason):
    assert one(spark, P.pair_reason(lit(ru), lit(en))) == reason


def test_keys_and_cleaners(spark):
    assert one(spark, T.exact_key(lit("  Ёж и  ЁЛКА!\n"))) == "еж и елка!"
    assert one(spark, T.token_key(lit("Don't_stop — Ёж, 2!"))) == "don't_stop еж 2"
    assert one(spark, T.subtitle_clean(lit("- <i>Да</i> [смех] {\\an8}ну... ♪"))) == "Да ну…"
    assert one(spark, T.cue_clean(lit("— Да ♪ ля-ля ♪ (хлопок) и — нет"))) == "Да и нет"
    assert one(spark, T.speech_words(lit("Э-э, кто-то -там- ЁЖ!"))) == ["э-э", "кто-то", "там", "еж"]
    assert one(spark, T.speech_words(lit("Э-э, ну угу да да"), True)) == ["ну", "да", "да"]
    assert one(spark, T.english_words(lit("I’m sure it's well-known: don't 'quote'"))) == "i am sure it is well known do not quote".split()
    assert one(spark, T.film_code(lit("1979/79679"))) == "tt0079679"
    assert one(spark, T.film_code(lit("x/123456789"))) == "tt123456789"
    assert one(spark, T.section(lit("# t\n## A\nbody\nmore\n## B\nx"), "A")) == "## A\nbody\nmore"
    assert one(spark, T.space_word_count(lit(""))) == 0
    assert one(spark, T.template("{a}-{b}", a=lit("x"), b=lit(1))) == "x-1"


def test_tiers_prefer_the_strongest(spark):
    tier = lambda t, lang: one(spark, G.tier(lit(t), lit(lang)))
    assert [tier("damn fuck", "en"), tier("pissed off", "en"), tier("pissed", "en"), tier("class hello", "en"), tier(None, "en")] == [3, 1, 2, 0, 0]
    assert [tier("чёрт возьми", "ru"), tier("фигура", "ru"), tier("хлеб и рубля", "ru"), tier("нахер", "ru"), tier("Сукин сын", "ru")] == [1, 0, 0, 2, 3]


def test_masks(spark):
    assert [one(spark, P.masked_in_row(lit(t))) for t in ("f***", "b#tch", "*emph*", "C#", "a*b", None)] == [True, True, False, False, True, False]


@pytest.mark.parametrize(
    ("reply", "want"),
    [
        ('{"translation": "a", "has_subtext": true, "category": "idiom", "nuance_note": "n"}', ("a", True, "idiom", "n")),
        ('```json\n{"translation": "a", "has_subtext": false, "category": "idiom", "nuance_note": "n"}\n```', ("a", False, "none", "n")),
        ('<think>{"x"}</think>{"translation": "a", "has_subtext": " TRUE ", "category": "sarcasm"}', ("a", True, "sarcasm", "")),
        ('hm {"translation": "a", "has_subtext": true, "category": "other"} ok', ("a", False, "none", "")),
        ('{"translation": 1}', None),
        ('{"has_subtext": true}', None),
        ("nothing", None),
        ('{"translation": "a"', None),
        (None, None),
    ],
)
def test_parse_reply(spark, reply, want):
    got = one(spark, G.parse_reply(lit(reply).cast("string")))
    assert (tuple(got) if got else None) == want


def test_answer_json_is_python_json(spark):
    import json

    got = one(spark, G.answer_json(lit('say "hi"\n'), lit(True), lit("idiom"), lit("é")))
    assert got == json.dumps({"translation": 'say "hi"\n', "has_subtext": True, "category": "idiom", "nuance_note": "é"}, ensure_ascii=False)


def test_mime(spark):
    pairs = [("text/plain", "*/*"), ("text/plain", "text/*"), ("image/png", "text/*"), ("text/plain", "text/plain"), ("text/plain", "text")]
    assert [one(spark, P.mime_matches(lit(a), lit(b))) for a, b in pairs] == [True, True, False, True, False]


def test_sequence_ratio_and_chrf(spark):
    long = "ab" * 150
    for a, b in (("abcd", "bcde"), (long, long[3:]), ("", "")):
        assert one(spark, udfs.sequence_ratio(lit(a), lit(b))) == pytest.approx(difflib.SequenceMatcher(None, a, b).ratio())
    assert one(spark, udfs.chrf(lit("the cat"), lit("the cat"))) == 100
    assert one(spark, udfs.chrf(lit("abc"), lit("xyz"))) == 0
    # one-letter precision 2/3, two-letter 1/2, three-letter 0/1; both sides alike, so F equals the mean
    assert one(spark, udfs.chrf(lit("abc"), lit("abd"))) == pytest.approx(100 * (2 / 3 + 1 / 2 + 0) / 3)


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_token_distance_is_the_edit_distance_of_words(spark):
    import random

    rng = random.Random(1)
    rows = [([rng.choice(["a", "bb", "ё", "", "a b", "日"]) for _ in range(rng.randrange(9))], [rng.choice(["a", "bb", "ё", "c", "日"]) for _ in range(rng.randrange(9))]) for _ in range(80)]
    rows += [([f"w{i}" for i in range(400)], [f"w{i}" for i in range(3, 403)]), ([], ["x"])]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a array<string>, b array<string>")
    got = {r.i: r.d for r in df.select("i", T.token_distance("a", "b").alias("d")).collect()}
    assert got == {i: slow_distance(a, b) for i, (a, b) in enumerate(rows)}
    assert one(spark, T.token_distance(F.lit(None).cast("array<string>"), F.array(lit("x")))) == 1


def test_splits_and_chunks(spark):
    parts = one(spark, intervals.equal_parts(lit(0.0), lit(10.0), 4.0))
    assert [(round(p.a, 6), round(p.b, 6)) for p in parts] == [(0.0, 3.333333), (3.333333, 6.666667), (6.666667, 10.0)]
    chunks = lambda t: [tuple(c) for c in one(spark, intervals.tumbling_chunks(lit(t), 300.0))]
    assert chunks(0.0) == [] and chunks(50.0) == [(0.0, 50.0)] and chunks(630.0) == [(0.0, 300.0), (300.0, 330.0)] and chunks(700.0) == [(0.0, 300.0), (300.0, 300.0), (600.0, 100.0)]

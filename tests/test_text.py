import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from plain_porter import stem
from textree.functions import porter
from textree.functions import text as fn
from textree.functions.stopwords import ENGLISH
from textree.operators import text as tx

DIRTY = [
    (1, "  See https://a.b/c?d=1 NOW, @joe_1! "),
    (2, "tab\there\nnew"),
    (3, "year 2024  was   42"),
    (4, "!!!"),
    (5, "   "),
    (6, None),
    (7, "Café déjà"),
    (8, "com://x y"),
]


def cleaned(df, **options):
    return {r["id"]: r["out"] for r in tx.clean(df, "title", "out", **options).collect()}


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(DIRTY, "id int, title string")


def test_chain(dirty):
    assert cleaned(dirty) == {
        1: "see  now ".replace("  ", " "),
        2: "tabherenew",
        3: "year was ",
        4: "",
        7: "caf dj",
        8: " y",
    }


def test_last_mode_shows_only_the_last_step(dirty):
    out = cleaned(dirty, mode="last")
    assert out[1] == "  See httpsabcd1 NOW joe1 "
    assert out[2] == "tab\there\nnew"
    assert out[4] == ""
    assert set(out) == {1, 2, 3, 4, 7, 8}
    assert 4 not in cleaned(dirty, mode="last", drop_empty_output=True)


def test_chained_in_place_filters_the_cleaned_text_and_merges_copies(spark):
    df = spark.createDataFrame([("A 1",), ("a 2",), ("12",)], "title string")
    assert [r["title"] for r in tx.clean(df, "title", "title").collect()] == ["a "]


def test_unknown_mode(dirty):
    with pytest.raises(ValueError):
        tx.clean(dirty, "title", mode="other")


def test_punctuation_class_on_every_character(spark):
    points = spark.range(1, 0x10000).filter("id NOT BETWEEN 55296 AND 57343")
    chars = points.select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    same = F.regexp_replace("c", r"[^a-zA-Z0-9\s]", "") == fn.clean_last(F.col("c"))
    assert chars.filter(~same).isEmpty()
    assert chars.filter(fn.clean_last(F.col("c")) != "").count() == 62 + 6


def test_drop_blank_rows(spark):
    df = spark.createDataFrame([("a", None), (" ", "\t"), (None, None)], "x string, y string")
    assert tx.drop_blank_rows(df).count() == 1


def test_tokens_and_places(spark):
    df = spark.createDataFrame([(1, " a  b c "), (2, "")], "id int, t string")
    rows = tx.token_rows(tx.tokenize(df, "t"), "id").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]


def test_stopword_list_is_sparks(spark):
    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_stopwords_ignore_case(spark):
    df = spark.createDataFrame([("The",), ("cat",), ("AND",)], "token string")
    assert [r["token"] for r in tx.remove_stopwords(df).collect()] == ["cat"]


PORTER = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "digitizer": "digit",
    "vietnamization": "vietnam", "hopefulness": "hope", "triplicate": "triplic", "electrical": "electr",
    "revival": "reviv", "adjustment": "adjust", "adoption": "adopt", "probate": "probat", "rate": "rate",
    "controlling": "control", "roll": "roll", "syzygy": "syzygi", "generalizations": "gener", "oscillators": "oscil",
}


@pytest.mark.parametrize("word", sorted(PORTER))
def test_porter_published_examples(word):
    assert stem(word) == PORTER[word]


def odd_words():
    """Published examples, endings put to beginnings with every run of y, and what is hardly a word."""
    endings = [*porter.STEP2, *porter.STEP3, *porter.STEP4, "s", "sses", "ies", "eed", "ed", "ing", "y", "e", "ll", "tted", "lled", "yyed", "yyying", "ated", "ized"]
    starts = ["", "b", "a", "y", "yy", "byy", "abyy", "ayyy", "yab", "str", "trouble", "hop", "fix", "snow", "play", "Éta", "x1", "Vex", "oooo", "opposit"]
    return [*PORTER, *(a + b for a in starts for b in endings), *("y" * n for n in range(1, 7)), "", "Y", "YES", "ing", "日本語s", "y" * 50_000 + "ed", "ab" * 50_000 + "ing"]


def test_stems_as_columns_are_the_plain_rules(spark):
    words = odd_words()
    df = spark.createDataFrame([(w,) for w in [*words, None]], "token string")
    got = {r["token"]: r["stem"] for r in df.withColumn("stem", fn.stem_column(F.col("token"))).collect()}
    assert got == {w: stem(w) for w in words} | {None: None}
    arrays = spark.createDataFrame([(words[:9],), ([],), (None,), (["cats", None],)], "tokens array<string>")
    found = arrays.select(porter.stems(F.col("tokens")).alias("s"))
    assert [r["s"] for r in found.collect()] == [[stem(w) for w in words[:9]], [], None, ["cat", None]]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [0, 10**9])
def test_stem_tokens_broadcast_and_salted(spark, limit):
    tokens = [(i, w) for i, w in enumerate(["running"] * 50 + ["ponies", "Cats", "sky"])]
    out = tx.stem_tokens(spark.createDataFrame(tokens, "id int, token string"), limit=limit)
    assert sorted((r["id"], r["stem"]) for r in out.collect()) == [(i, stem(w)) for i, w in tokens]

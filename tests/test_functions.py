from datetime import date

import pytest
from pyspark.sql import functions as F

from ratingscope import functions as rf
from ratingscope.functions import text


def values(spark, rows, column, schema="c string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(column(F.col("c"))).collect()]


def test_imdb_id_keeps_long_ids(spark):
    raw = ["862", "0114709", "10872600", None]
    assert values(spark, raw, rf.imdb_id) == ["tt0000862", "tt0114709", "tt10872600", None]


def test_digits_only(spark):
    assert values(spark, ["862", "1997-08-20", "3000000000", "", None, "-1"], rf.digits_only_int) == [
        862, None, None, None, None, None
    ]


def test_lenient_numbers(spark):
    raw = ["862", "862.0", ".5", ".", "-", "1e3", "3000000000", " 7 ", "", None, "-12.9", "+4", "x", "1.2.3"]
    assert values(spark, raw, rf.lenient_int) == [
        862, 862, 0, 0, None, None, None, 7, None, None, -12, 4, None, None
    ]
    assert values(spark, raw, rf.lenient_long)[6] == 3000000000
    assert values(spark, raw, rf.lenient_double) == [
        862.0, 862.0, 0.5, None, None, 1000.0, 3e9, 7.0, None, None, -12.9, 4.0, None, None
    ]


def test_dates_first_format_wins(spark):
    raw = ["1997-08-20", "1997/08/20", "03/04/1995", "25/12/1995", "3/4/1995", "1995", "", None]
    assert values(spark, raw, rf.parse_date) == [
        date(1997, 8, 20), date(1997, 8, 20), date(1995, 3, 4), date(1995, 12, 25), None, None, None, None
    ]


def test_month_dates(spark):
    raw = ["September 9, 2019", "Sep 9, 2019", "9/9/2019", " August 1, 2020", "2019-09-09", None]
    assert values(spark, raw, rf.parse_month_date) == [
        date(2019, 9, 9), date(2019, 9, 9), date(2019, 9, 9), None, None, None
    ]


def test_json_names(spark):
    raw = ["[{'id': 16, 'name': 'Animation'}, {'id': 35, 'name': \"O'Comedy\"}]", "[]", "[{'id':", None]
    assert values(spark, raw, rf.json_names) == [["Animation", "O'Comedy"], [], None, None]


def test_title_tokens(spark):
    raw = ["The Good, the Bad", "WALL·E", "", None, "東京", "Kelvin İz", "--a--"]
    assert values(spark, raw, rf.title_tokens) == [
        ["the", "good", "bad"], ["wall", "e"], [], [], [], ["elvin", "z"], ["a"]
    ]
    blank = values(spark, raw, lambda c: rf.title_tokens(c, blank_matches=True))
    assert blank[2:5] == [[""], [""], [""]] and blank[0] == ["the", "good", "bad"]


def test_clean_review(spark):
    raw = ["['Great film.', 'Its fun\\n']", "coming-of-age, don't", None]
    assert values(spark, raw, rf.clean_review) == ["Great film Its funn", "comingofage dont", None]
    assert values(spark, raw, lambda c: rf.clean_review(c, glue=False))[1] == "coming of age  dont"


def test_words(spark):
    raw = ["The  quick\tBrown fox is dont ", "", None]
    assert values(spark, raw, rf.words_of) == [["quick", "brown", "fox", "dont"], [], []]
    assert values(spark, raw, lambda c: rf.words_of(c, []))[0] == ["the", "quick", "brown", "fox", "is", "dont"]


def test_default_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    from ratingscope.functions.stopwords import ENGLISH

    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")


def test_words_equal_ml_transformers(spark):
    from pyspark.ml.feature import StopWordsRemover, Tokenizer

    df = spark.createDataFrame([("I don't   think It is WRONG",), ("a  b\tc The End ",)], "t string")
    df = df.withColumn("clean", rf.clean_review(F.col("t")))
    tokens = Tokenizer(inputCol="clean", outputCol="tok").transform(df)
    removed = StopWordsRemover(inputCol="tok", outputCol="ml").transform(tokens)
    for row in removed.select("ml", rf.words_of(F.col("clean")).alias("own")).collect():
        assert [w for w in row.ml if w] == row.own


def test_positive_flag(spark):
    assert values(spark, ["Positive", "POSITIVE", "negative", None], rf.is_positive) == [1.0, 1.0, 0.0, 0.0]


def test_escape_quotes(spark):
    assert values(spark, ['a "b"', None], rf.escape_quotes) == ['a \\"b\\"', None]


def test_strip_takes_unicode_space(spark):
    assert values(spark, ["  a b　\n", None], rf.strip) == ["a b", None]


def test_slugs(spark):
    raw = ["Don't Look & Up: 2 — Ünïon", "!leading", "trailing?", " A  B ", None]
    assert values(spark, raw, rf.slug_squeezed) == [
        "dont_look_and_up_2_ünïon", "_leading", "trailing_", "a_b", None
    ]
    assert values(spark, raw, rf.slug_plain)[3] == "a__b"
    url = values(spark, ["heat", None], rf.review_url)
    assert url[0].endswith("/m/heat/reviews") and url[1] is None


@pytest.mark.parametrize(
    ("title", "clean"),
    [("Heat", True), ("It's: a-title!", True), ("b’s ×·–…™", True), ("a — b", False), ("½ 2²", True), ("Ünïon", True)],
)
def test_clean_titles(spark, title, clean):
    assert values(spark, [title], rf.is_clean_title) == [clean]


def test_resolve_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "IMDB_ID int, Review int, other int")
    assert rf.resolve_columns(df, ["imdb_id", "review", "sentiment"]).columns == ["imdb_id", "review", "other"]


def test_kept_characters_are_named_one_by_one(spark):
    """All of the first code points, and some beyond; the list holds no range."""
    import re

    points = [*range(1, 0x250), 0x2003, 0x3000, 0x4E2D, 0x1F600]
    rows = [(n, "a" + chr(n) * 2 + "[b]'") for n in points]
    df = spark.createDataFrame(rows, "n int, t string")
    got = df.select("n", text.clean_review(F.col("t")).alias("g"), text.clean_review(F.col("t"), glue=False).alias("s")).collect()
    for n, t in rows:
        glued, spaced = next((r.g, r.s) for r in got if r.n == n)
        assert glued == re.sub(r"[^a-zA-Z0-9 \t\n\x0b\f\r]", "", t)
        assert spaced == re.sub(r"[^a-zA-Z0-9 \t\n\x0b\f\r]", " ", re.sub(r"[\[\]']", "", t))
    assert "-" not in text.KEPT

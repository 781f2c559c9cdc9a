"""Scalar functions on edge values."""

from pyspark.sql import functions as F

from ferrolith.functions import dates, numbers, text
from ferrolith.plans.dating import INTEREST_EDGES, INTEREST_LABELS


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


def test_first_decimal(spark):
    rows = ["Avec une note de 8.5", "Note : 7,2", "9", None, "abc"]
    assert values(spark, rows, "string", text.first_decimal) == [8.5, 7.2, 0.0, 0.0, 0.0]
    assert values(spark, rows, "string", lambda c: text.first_decimal(c, True)) == [8.5, 7.2, 9.0, 0.0, 0.0]


def test_clean_message_keeps_accents_and_digits(spark):
    rows = ["Été_à 9h!!", "...", None, "WIN £1000 now"]
    assert values(spark, rows, "string", text.clean_message) == ["été à 9h ", " ", "", "win 1000 now"]


def test_words_and_bigrams(spark):
    rows = ["a bb ccc dd", "bb", "", "x y"]
    assert values(spark, rows, "string", text.words) == [["bb", "ccc", "dd"], ["bb"], [], []]
    grams = lambda c: text.bigrams(text.words(c))
    assert values(spark, rows, "string", grams) == [["bb ccc", "ccc dd"], [], [], []]


def test_plate_keys(spark):
    rows = ["AB-123-CD", "ab 123 cd", "", "é12"]
    assert values(spark, rows, "string", text.plate_key) == ["AB123CD", "AB123CD", "", "12"]


def test_urls_digits_and_shortening(spark):
    assert values(spark, ["/hotel", "https://x.org/a", None], "string", lambda c: text.absolute_url(c, "https://b.org")) == [
        "https://b.org/hotel", "https://x.org/a", "https://b.org"]
    assert values(spark, ["120 €", None, "abc"], "string", text.digits_only) == ["120", "0", ""]
    assert values(spark, ["abc", "abcdef"], "string", lambda c: text.shorten(c, 4)) == ["abc...", "abcd..."]
    assert values(spark, ["<b>a</b>,<br>b", None], "string", text.strip_tags) == ["a,b", None]


def test_join_fragments(spark):
    df = spark.createDataFrame([([" a ", "", "b"],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(text.join_fragments(F.col("v"))).collect()] == ["a b", ""]


def test_is_free(spark):
    rows = [None, "0", "", "abc", "499", "0.0"]
    assert values(spark, rows, "string", numbers.is_free) == [True, True, False, False, False, True]


def test_right_closed_bins(spark):
    rows = [-1.0, -0.99, -0.33, -0.32, 0.33, 0.34, 1.0, 1.1, None]
    bins = lambda c: numbers.right_closed_bin(c, INTEREST_EDGES, INTEREST_LABELS)
    assert values(spark, rows, "double", bins) == [
        None, "Faible", "Faible", "Moyenne", "Moyenne", "Forte", "Forte", None, None]


def test_interval_and_boxes(spark):
    got = values(spark, [100.0, -50.0], "double", numbers.price_interval)
    assert (got[0]["low"], got[0]["high"]) == (85.0, 115.0)
    assert got[1]["low"] == 0.0
    df = spark.createDataFrame([(0.4, 0.2), (0.4, 0.0)], "w double, h double")
    assert [r[0] for r in df.select(numbers.box_ratio(F.col("w"), F.col("h"))).collect()] == [2.0, 0.0]


def test_rounding_and_text(spark):
    assert values(spark, [0.125, 0.375], "double", lambda c: numbers.round_half_even(c, 2)) == [0.12, 0.38]
    assert values(spark, [0.1234], "double", numbers.percent_text) == ["12.34%"]
    assert values(spark, [5, None], "int", lambda c: numbers.clip(c, 0, 1)) == [1, None]


def test_dates(spark):
    rows = ["2012/11/1", "2012/11/21", "Nov 2012", None]
    parsed = values(spark, rows, "string", lambda c: F.year(dates.parse_date(c, "yyyy/MM/d")))
    assert parsed == [2012, 2012, None, None]
    assert values(spark, ["2024-01-01", "2024-01-07"], "string", lambda c: dates.weekday(c.cast("date"))) == [0, 6]


def test_codes_and_search(spark):
    labels = lambda c: numbers.code_label(c, {0: "Femmes", 1: "Hommes"})
    assert values(spark, [0, 1, 7, None], "int", labels) == ["Femmes", "Hommes", None, None]
    assert values(spark, ["Martin", None], "string", lambda c: text.matches_search([c], "MART")) == [True, False]

from decimal import Decimal

from pyspark.sql import functions as F

from marquee.functions import text


def values(spark, rows, ddl, column):
    df = spark.createDataFrame(rows, ddl)
    return [r[0] for r in df.select(column.alias("out")).collect()]


def test_parse_money(spark):
    rows = [("USD 1,234,567",), ("EUR 5.555",), ("1.2.3",), ("USD",), ("",), (None,)]
    got = values(spark, rows, "s STRING", text.parse_money(F.col("s")))
    assert got == [Decimal("1234567.00"), Decimal("5.56"), None, None, None, None]


def test_money_round_trip(spark):
    rows = [("1234567", "USD"), ("12", None), (None, "USD"), ("999", "EUR")]
    got = values(spark, rows, "a STRING, c STRING", text.format_money(F.col("a"), F.col("c")))
    assert got == ["USD 1,234,567", " 12", None, "EUR 999"]


def test_tokens(spark):
    rows = [("Ann, Bob,,Cy",), (" ",), (None,), ("A , B\t",)]
    assert values(spark, rows, "s STRING", text.tokens(F.col("s"))) == [["Ann", "Bob", "Cy"], [], [], ["A", "B"]]
    assert values(spark, [(None,)], "s STRING", text.tokens(F.col("s"), "nan")) == [["nan"]]


def test_flags_and_numbers(spark):
    rows = [("Sim",), (" sim ",), ("Não",), (None,)]
    assert values(spark, rows, "s STRING", text.is_affirmative(F.col("s"))) == [True, True, False, False]
    rows = [("7.9",), ("-3.5",), ("x",), (None,), ("2004",)]
    assert values(spark, rows, "s STRING", text.whole_number(F.col("s"))) == [7, -3, None, None, 2004]


def test_missing_tokens(spark):
    rows = [("N/A",), ("nan",), ("None",), ("ok",), ("",), (None,)]
    assert values(spark, rows, "s STRING", text.na_to_null(F.col("s"))) == [None, None, None, "ok", None, None]


def test_dates_and_names(spark):
    rows = [(2024, 2, 31), (2024, None, 1)]
    got = values(spark, rows, "y INT, m INT, d INT", text.date_from_parts(F.col("y"), F.col("m"), F.col("d")))
    assert got == ["2024-02-31", None]
    rows = [([("A",), ("B",)],), (None,), ([],)]
    assert values(spark, rows, "a ARRAY<STRUCT<name STRING>>", text.joined_names(F.col("a"))) == ["A, B", None, ""]


def test_urls(spark):
    base = "https://site.org/title/t1/reviews?x=1"
    hrefs = ["https://o.org/movie/a-b?q=1", "/movie/c", "//cdn.org/z", "more"]
    got = values(spark, [(base, h) for h in hrefs], "b STRING, h STRING", text.absolute_url(F.col("b"), F.col("h")))
    assert got == ["https://o.org/movie/a-b?q=1", "https://site.org/movie/c", "https://cdn.org/z", "https://site.org/title/t1/more"]
    got = values(spark, [(g,) for g in got], "u STRING", text.slug_after(F.col("u"), "/movie/"))
    assert got == ["a-b", "c", None, None]


def test_award_status(spark):
    rows = [(True, True), (True, False), (False, False)]
    got = values(spark, rows, "n BOOLEAN, w BOOLEAN", text.award_status(F.col("n"), F.col("w")))
    assert got == ["🏆 Vencedor", "🎬 Indicado", ""]

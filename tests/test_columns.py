import datetime as dt

import pytest
from pyspark.sql import functions as F

from gustledger.functions import columns as C
from gustledger.operators import cleaning


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def values(df, name="x"):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize(
    "text", ["", " ", "\t\n", " ", "  ", "\x1d", "null", "NULL", "NaN", "nan", "N/A", "n/a", "-"]
)
def test_null_tokens(spark, text):
    df = spark.createDataFrame([(text, "kept")], "a string, b string")
    assert tuple(cleaning.clean_null_tokens(df).first()) == (None, "kept")


@pytest.mark.parametrize("text", ["a", " a", "-1", "Null", "élo", "nan ", "--", "it's"])
def test_other_text_is_kept(spark, text):
    df = spark.createDataFrame([(text,)], "a string")
    assert cleaning.clean_null_tokens(df).first()["a"] == text


@pytest.mark.parametrize(
    "text, number",
    [("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("abc", None), ("", None), ("12,3", None), ("NaN", None),
     ("1.0d", None), ("2f", None), ("-", None), (None, None)],
)
def test_to_double(spark, text, number):
    assert one(spark, C.to_double(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize("text, number", [("1.0", 1), ("0", 0), ("7", 7), ("x", None), ("1e30", None)])
def test_to_int(spark, text, number):
    assert one(spark, C.to_int(F.lit(text))) == number


def test_to_instant(spark):
    assert one(spark, C.to_instant(F.lit("2024-01-05 10:30:00"))) == dt.datetime(2024, 1, 5, 10, 30)
    assert one(spark, C.to_instant(F.lit("not a date"))) is None


def test_wind_range_and_flag(spark):
    rows = [(-0.1, None), (0.0, None), (40.0, None), (40.1, None), (None, None), (float("nan"), None), (5.0, 1), (5.0, 0)]
    df = spark.createDataFrame(rows, "v double, f int")
    got = values(df.select(C.soft_drop(F.col("v"), 0, 40, F.col("f") == 1).alias("x")))
    assert got == [None, 0.0, 40.0, None, None, None, None, 5.0]


def test_limit_flag(spark):
    rows = [(10.0, 8.0, 99.0), (10.0, None, 12.0), (10.0, None, None), (10.0, 10.0, 1.0), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "l double, f double, i double")
    got = values(df.select(C.exceeds_reference(F.col("l"), F.col("f"), F.col("i")).alias("x")))
    assert got == [1, 0, 0, 0, 0]


def test_embedded_key(spark):
    for code, key in [("EOL.CV.RN.037102-5.01", "037102-5"), ("-", ""), (None, None)]:
        assert one(spark, C.embedded_key(F.lit(code).cast("string"), r"\d{6}-\d")) == key


def test_choose_key(spark):
    df = spark.createDataFrame([("II", "g", "p"), ("I", "g", "p"), (None, "g", "p")], "m string, g string, p string")
    assert values(df.select(C.choose_key(F.col("m"), "II", F.col("g"), F.col("p")).alias("x"))) == ["g", "p", "p"]


def test_weekend(spark):
    days = [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    assert values(df.withColumns(C.calendar(F.col("t"))), "flg_fim_semana") == [0, 1, 1, 0]


def test_slots_cover_whole_months(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 3, 5), dt.datetime(2024, 2, 10, 7, 30))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(C.slots_between(F.col("a"), F.col("b")).alias("x")).first()["x"] == 60 * 48


def test_period_rejects_unknown_grain():
    with pytest.raises(ValueError):
        C.period(F.lit(None), "semanal")


def test_month_labels(spark):
    got = one(spark, C.month_labels(F.lit("2026-06-15").cast("date")))
    assert got == ["2025_12", "2026_01", "2026_02", "2026_03", "2026_04", "2026_05"]


@pytest.mark.parametrize("v, digits, want", [(0.125, 2, 0.13), (2.675, 2, 2.68), (-0.125, 2, -0.13), (1.04, 1, 1.0)])
def test_round_half_up(spark, v, digits, want):
    assert one(spark, C.round_half_up(F.lit(v), digits)) == want


def test_percent_of_nothing_is_zero(spark):
    assert one(spark, C.percent(F.lit(0), F.lit(0), 1)) == 0.0


def test_coerce_numbers_by_name(spark):
    df = spark.createDataFrame([("1,0", "x", "2.5", float("nan"))], "val_a string, nome string, flg_b string, val_c float")
    got = cleaning.coerce_numbers(df)
    assert tuple(got.first()) == (None, "x", 2.5, None)
    assert [f.dataType.simpleString() for f in got.schema] == ["double", "string", "double", "double"]

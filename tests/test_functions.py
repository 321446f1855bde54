import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotelake import functions as fn
from tests.conftest import one


def value(spark, column):
    return one(spark.range(1).select(column.alias("v")))["v"]


@pytest.mark.parametrize(
    "text, number",
    [("12.7", 13), ("1e3", 1000), ("5", 5), (" 5 ", 5), ("-2.5", -3), ("1,234", None), ("", None), ("-", None), (None, None)],
)
def test_try_bigint(spark, text, number):
    assert value(spark, fn.try_bigint(F.lit(text).cast("string"))) == number


def test_strict_number_fails_the_job(spark):
    df = spark.createDataFrame([("x1",)], "s string").select(fn.strict_bigint("s"))
    with pytest.raises(Exception, match="not a number"):
        df.collect()


@pytest.mark.parametrize(
    "x, digits, expected", [(1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.12345, 4, 0.1235), (-0.00001, 2, 0.0)]
)
def test_round_scaled(spark, x, digits, expected):
    got = value(spark, fn.round_scaled(F.lit(x), digits))
    assert got == expected and str(got) != "-0.0"


def test_round_stable_ignores_summation_noise(spark):
    for noise in (-1e-13, 0.0, 1e-13):
        assert value(spark, fn.round_stable(F.lit(10.125 + noise), 2)) == 10.13


def test_safe_ratio_of_zero_is_null(spark):
    assert value(spark, fn.safe_ratio(F.lit(1), F.lit(0), 2)) is None
    assert value(spark, fn.safe_ratio(F.lit(2), F.lit(3), 2)) == 0.67


@pytest.mark.parametrize(
    "text, expected", [("_A_B_", "A_B_"), ("abc", "abc"), ("x\ny_z_", "x\nyz_"), ("", "")]
)
def test_first_replace(spark, text, expected):
    assert value(spark, fn.first_replace(F.lit(text), "_", "")) == expected


def test_first_replace_before_a_digit(spark):
    assert value(spark, fn.first_replace(F.lit("5→6→7"), "→", "0")) == "506→7"


def test_title_case(spark):
    assert value(spark, fn.title_case(F.lit("ACME  holdings OF ßtadt"))) == "Acme  Holdings Of ẞtadt"


def test_dates(spark):
    assert value(spark, fn.compact_date_int(F.lit("2025-03-10"))) == 20250310
    assert value(spark, fn.compact_date_int(F.lit("soon"))) is None
    assert value(spark, fn.calendar_text_date(F.lit("12/31/2024"))) == dt.date(2024, 12, 31)
    assert value(spark, fn.week_end(F.lit("2025-03-10").cast("date"))) == dt.date(2025, 3, 16)
    assert value(spark, fn.week_end(F.lit("2025-03-16").cast("date"))) == dt.date(2025, 3, 16)


def test_canonical_keeps_unknown_and_null(spark):
    assert value(spark, fn.canonical(F.lit("a"), {"a": "b"})) == "b"
    assert value(spark, fn.canonical(F.lit("c"), {"a": "b"})) == "c"
    assert value(spark, fn.canonical(F.lit(None).cast("string"), {"a": "b"})) is None

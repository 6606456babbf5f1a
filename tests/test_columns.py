"""NULL and boundary cases of the column helpers."""

import decimal
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from creatorlens.functions import display, scalars


def evaluate(spark, kind, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_ratio(spark):
    df = spark.createDataFrame([(10, 4), (1, 0), (None, 2), (1, None)], "a long, b long")
    rows = df.select(scalars.ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [row.r for row in rows] == [2.5, None, None, None]


def test_greatest_is_null_strict(spark):
    out = evaluate(spark, "int", [None, 0, 5], lambda x: scalars.greatest_strict(x, F.lit(1)))
    assert out == [None, 1, 5]


@pytest.mark.parametrize(
    "value,tier",
    [
        (10_000_000, "mega"), (9_999_999, "large"), (1_000_000, "large"), (999_999, "medium"),
        (100_000, "medium"), (99_999, "small"), (10_000, "small"), (9_999, "micro"), (None, "micro"),
    ],
)
def test_size_tier(spark, value, tier):
    assert evaluate(spark, "long", [value], scalars.size_tier) == [tier]


def test_duration_category(spark):
    out = evaluate(spark, "long", [0, 59, 60, 599, 600, 3599, 3600, None], scalars.duration_category)
    assert out == ["short", "short", "medium", "medium", "long", "long", "very_long", "very_long"]


def test_performance_tier(spark):
    out = evaluate(spark, "double", [3.0, 2.99, 1.5, 1.49, 0.5, 0.49, None], scalars.performance_tier)
    assert out == [
        "viral", "above_average", "above_average", "average", "average", "below_average",
        "below_average",
    ]


def test_has_text_knows_all_white_space(spark):
    out = evaluate(spark, "string", ["a", " ", "\t\n", "  ", "", None], scalars.has_text)
    assert out == [True, False, False, False, False, None]


def test_iso_day(spark):
    out = evaluate(spark, "string", ["20240131", "20240231", "soon", "", None, "2024-01-31"], scalars.iso_day)
    assert out == ["2024-01-31", "20240231", "soon", None, None, "2024-01-31"]


def test_first_filled_and_clip(spark):
    assert evaluate(spark, "string", ["", None, "a"], lambda x: scalars.first_filled(x, F.lit("b"))) == [
        "b", "b", "a",
    ]
    assert evaluate(spark, "string", [None, "abc", "ünïcode"], lambda x: scalars.clip(x, 3)) == [
        "", "abc", "ünï",
    ]


def test_days_between_defaults_to_today(spark):
    assert evaluate(spark, "date", [date(2024, 1, 1)], lambda x: scalars.days_between(date(2024, 1, 31), x)) == [30]
    assert evaluate(spark, "date", [date(2024, 1, 1)], lambda x: scalars.days_between(None, x))[0] > 365


def half_up(value, digits):
    step = decimal.Decimal(1).scaleb(-digits)
    return str(decimal.Decimal(value).quantize(step, rounding=decimal.ROUND_HALF_UP))


def test_fixed_point_rounds_the_exact_value(spark):
    random.seed(5)
    values = [1.45, 1.35, 0.25, 0.75, 1.005, 2.5, 0.0, 999.95, 0.049999999999999996]
    values += [random.random() * 10 ** random.randint(-3, 6) for _ in range(500)]
    values += [i / 1000 for i in range(0, 9999, 45)] + [i / 128 for i in range(200)]
    for digits in (1, 2):
        out = evaluate(spark, "double", values, lambda x: display.fixed_point(x, digits))
        assert out == [half_up(value, digits) for value in values]
    assert evaluate(spark, "double", [-1.25, None], lambda x: display.fixed_point(x, 1)) == ["-1.3", None]


def test_compact_number(spark):
    values = [None, 0, 7, 999, 1000, 1450, 999_949, 1_000_000, 2_350_000_000, -1234]
    assert evaluate(spark, "long", values, display.compact_number) == [
        "0", "0", "7", "999", "1.0K", "1.4K", "999.9K", "1.0M", "2.4B", "-1,234",
    ]
    assert evaluate(spark, "double", [12.34567, 0.5, 12.0], display.compact_number) == ["12.346", "0.5", "12"]
    plain = lambda x: display.compact_number(x, guarded=False)
    assert evaluate(spark, "long", [None, 0, 7, 1500], plain) == [None, "0", "7", "1.5K"]


def test_percent(spark):
    assert evaluate(spark, "double", [None, 0.0, 0.12345, 1.0], display.percent) == [
        "0%", "0%", "12.35%", "100.00%",
    ]
    plain = lambda x: display.percent(x, guarded=False)
    assert evaluate(spark, "double", [None, 0.0], plain) == ["0.00%", "0.00%"]


def test_duration_text(spark):
    values = [None, 0, 5, 65, 3600, 3659, 3660, 7325]
    assert evaluate(spark, "long", values, display.duration_text) == [
        "N/A", "N/A", "0:05", "1:05", "60:00", "60:59", "1h 1m", "2h 2m",
    ]


def test_labels(spark):
    assert evaluate(spark, "int", [1, 7, None], display.day_label) == ["Sun", "Sat", None]
    assert evaluate(spark, "string", ["ID", "GLOBAL", None], display.region_label) == [
        "Indonesia", "Global", "Global",
    ]
    assert evaluate(spark, "string", ["above_average", "viral"], display.tier_label) == ["above avg", "viral"]
    assert evaluate(spark, "string", ["very_long", "other"], display.duration_label) == [">1 hour", "other"]
    assert evaluate(spark, "string", ["a_b_c"], display.spaced) == ["a b c"]
    assert evaluate(spark, "string", ["abcdef", "abc", None], lambda x: display.ellipsize(x, 3)) == [
        "abc…", "abc", None,
    ]
    assert evaluate(spark, "double", [2.5, -2.5, 2.4], display.round_half_up) == [3, -2, 2]
    assert evaluate(spark, "double", [90.0, None], display.minutes_text) == ["2m", "0m"]


def test_settings_follow_the_input():
    from creatorlens.session import settings

    small, large = settings(10_000_000, 8), settings(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "50000"
    assert large["spark.sql.files.maxPartitionBytes"] == str(500_000_000)

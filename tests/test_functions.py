import datetime as dt

import pytest
from pyspark.sql import functions as F

from martweave.functions import arrays, dates, numbers, text
from martweave.plans import university


def value(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize(
    "agent, device, browser",
    [
        ("Mozilla/5.0 (iPhone) Safari/604", "mobile", "Safari"),
        ("Mozilla/5.0 (iPad) Mobile/15 Safari", "mobile", "Safari"),
        ("Mozilla/5.0 (iPad) Safari", "tablet", "Safari"),
        ("Chrome/120 Safari Edg/120", "desktop", "Edge"),
        ("Chrome/119 Safari OPR/105", "desktop", "Chrome"),
        ("Opera/9.80", "desktop", "Opera"),
        ("MSIE 8.0", "desktop", "IE"),
        ("CriOS/99", "mobile", "Chrome"),
        ("curl", "desktop", "Other"),
    ],
)
def test_agent(spark, agent, device, browser):
    both = F.array(text.device_type(F.lit(agent)), text.browser(F.lit(agent)))
    assert value(spark, both) == [device, browser]


@pytest.mark.parametrize("ip, number", [("1.2.3.4", 16909060), ("255.255.255.255", 2**32 - 1), ("256.1.1.1", None), ("1.2.3", None)])
def test_ip(spark, ip, number):
    assert value(spark, text.ipv4_number(F.lit(ip))) == number


@pytest.mark.parametrize(
    "stamp, clock",
    [
        ("2024-01-01T03:04:05+05:30", dt.datetime(2024, 1, 1, 3, 4, 5)),
        ("2024-01-01T03:04:05.250-0800", dt.datetime(2024, 1, 1, 3, 4, 5, 250000)),
        ("2024-01-01 03:04Z", dt.datetime(2024, 1, 1, 3, 4)),
        ("2024-01-01T03", dt.datetime(2024, 1, 1, 3)),
        ("2024-01-01", dt.datetime(2024, 1, 1)),
        ("2024-01-32", None),
        ("2024", None),
        ("soon", None),
    ],
)
def test_wall_clock(spark, stamp, clock):
    assert value(spark, dates.wall_clock(F.lit(stamp))) == clock


def test_dates(spark):
    assert value(spark, dates.date_from_parts(F.lit(2017), F.lit("July"), F.lit(3))) == dt.date(2017, 7, 3)
    assert value(spark, dates.days_before(F.lit("2024-03-01").cast("date"), F.lit(1))) == dt.date(2024, 2, 29)
    assert value(spark, dates.iso_utc(F.lit("2024-01-01 00:00:00").cast("timestamp"))) == "2024-01-01T00:00:00+00:00"
    stamp = F.lit("2024-01-01 00:00:00.25").cast("timestamp")
    assert value(spark, dates.iso_utc(stamp)) == "2024-01-01T00:00:00.250000+00:00"


def test_numbers(spark):
    assert value(spark, numbers.currency_text(F.lit(12.5))) == "$13"
    assert value(spark, numbers.currency_text(F.lit("12.50").cast("decimal(10,2)"), "€", 2)) == "€12.50"
    assert value(spark, numbers.currency_text(F.lit(None).cast("decimal(10,2)"))) is None
    assert float(value(spark, numbers.ceil_to(F.lit("2.001").cast("decimal(10,3)"), 2))) == 2.01
    assert float(value(spark, numbers.ceil_to(F.lit("2.00").cast("decimal(10,3)"), 2))) == 2.0
    assert value(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, numbers.ratio_or_zero(F.lit(1.0), F.lit(-2.0))) == 0.0
    assert value(spark, numbers.page_count(F.lit(21), 10)) == 3
    assert value(spark, numbers.float_from_text(F.lit("inf"))) == float("inf")


def test_arrays(spark):
    a = F.array(F.lit("x"), F.lit("y"), F.lit("x"))
    assert value(spark, arrays.add_to_set(a, F.lit("x"))) == ["x", "y", "x"]
    assert value(spark, arrays.add_to_set(a, F.lit("z"))) == ["x", "y", "x", "z"]
    assert value(spark, arrays.add_to_set(F.lit(None).cast("array<string>"), F.lit("z"))) == ["z"]
    assert value(spark, arrays.push(a, F.lit("x"))) == ["x", "y", "x", "x"]
    assert value(spark, arrays.pull(a, F.array(F.lit("x")))) == ["y"]
    assert value(spark, arrays.nth(a, 1)) == "y" and value(spark, arrays.nth(a, 9)) is None
    assert value(spark, arrays.first_n(a, 2)) == ["x", "y"]
    assert value(spark, arrays.contains(a, F.lit("y"))) is True
    assert value(spark, arrays.missing_names(["b", "a", "c"], F.array(F.lit("c")))) == ["a", "b"]
    nested = F.struct(F.lit(1).alias("p"), F.struct(F.lit(2).alias("q")).alias("r"))
    assert value(spark, arrays.set_field(nested, "r.q", F.lit(5)))["r"]["q"] == 5


@pytest.mark.parametrize("mark, grade, point", [(100, "A", 4.0), (90, "A", 4.0), (89.5, "A-", 3.7), (60, "D", 1.0), (59.5, "F", 0.0)])
def test_grades(spark, mark, grade, point):
    row = university.grade_marks(spark.createDataFrame([(float(mark),)], "mark double")).first()
    assert (row.grade, float(row.grade_point)) == (grade, point)


@pytest.mark.parametrize("year, level", [(2025, 1), (2024, 2), (2023, 3), (2020, 3), (2030, 1)])
def test_study_year(spark, year, level):
    assert value(spark, university.study_year(F.lit(year))) == level

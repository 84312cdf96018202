import datetime as dt

from pyspark.sql import functions as F

from relcast.functions.parsing import null_if, pad_id, parse_date, parse_date_any, parse_double, parse_int


def col_values(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_money(spark):
    assert col_values(spark, ["$1,234.50", "12%", "1,000", "", None], parse_double) == [1234.5, 12.0, 1000.0, None, None]


def test_int_with_fraction_matches_lenient_cast(spark):
    values = ["12.5", "-3.9", ".5", "1e3", "99999999999", " 7 ", ".", "-.", "+", "5.", "abc", "2147483647", "2147483648"]
    assert col_values(spark, values, parse_int) == [12, -3, 0, None, None, 7, 0, 0, None, 5, None, 2147483647, None]


def test_suppression_markers(spark):
    got = col_values(spark, ["*", "NA", "N/A", "4"], lambda c: null_if(c, ("*", "NA", "N/A")))
    assert got == [None, None, None, "4"]


def test_dates(spark):
    day = dt.date(2024, 1, 2)
    assert col_values(spark, ["01/02/2024"], lambda c: parse_date(c, "MM/dd/yyyy")) == [day]
    assert col_values(spark, ["1/2/2024"], lambda c: parse_date(c, "M/d/yyyy")) == [day]
    assert col_values(spark, ["01/02/24"], lambda c: parse_date(c, "MM/dd/yy")) == [day]
    assert col_values(spark, ["TBD"], lambda c: parse_date(c, "MM/dd/yyyy")) == [None]
    assert col_values(spark, ["1/2/2024", "2024-01-02", "x"],
                      lambda c: parse_date_any(c, ("MM/dd/yyyy", "M/d/yyyy", "yyyy-MM-dd"))) == [day, day, None]


def test_strict_dates_fail_on_leftovers(spark):
    import pytest

    df = spark.createDataFrame([("01/02/2024",), ("garbage",)], "v string")
    with pytest.raises(Exception):
        df.select(parse_date_any("v", ("MM/dd/yyyy",), strict=True)).collect()


def test_pad(spark):
    assert col_values(spark, ["12345", "1234567"], lambda c: pad_id(c, 6)) == ["012345", "123456"]


def test_two_digit_years_of_guessed_formats(spark):
    formats = ("MM/dd/yyyy", "MM/dd/yy")
    got = col_values(spark, ["03/15/98", "03/15/68", "03/15/69", "03/15/1998"], lambda c: parse_date_any(c, formats))
    assert [d.year for d in got] == [1998, 2068, 1969, 1998]
    assert col_values(spark, ["03/15/98"], lambda c: parse_date_any(c, ("MM/dd/yy",)))[0].year == 2098  # one declared format

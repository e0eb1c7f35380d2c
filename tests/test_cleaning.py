import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordloom.functions import cleaning as c


def test_zip_shapes(values):
    cases = {
        "N/A": None, " na ": None, "NA": None, "\tn/a\n": None,
        "anonymous": "Anonymous", " ANONYMOUS ": "Anonymous",
        "10001": "10001", "00501": "00501", "abcde": "abcde", " 1001": " 1001",
        "100010001": "100010001", "123 45678": "123 45678",
        "10001-1234": "10001-1234", "10001x1234": None, "1000-12345": None,
        "1234": None, "123456": None, "10001-12345": None, "": None, None: None,
        "ééééé": "ééééé",
    }
    assert values(c.clean_zip, cases) == list(cases.values())


def test_borough_spellings_and_defaults(values):
    cases = {
        "MANHATTAN": "Manhattan", "new york county": "Manhattan", " Bronx ": "Bronx", "THE BRONX": "Bronx",
        "brooklyn": "Brooklyn", "Kings County": "Brooklyn", "QUEENS": "Queens", "Queen": "Queens",
        "queens county": "Queens", "Staten Island": "Staten Island", "RICHMOND COUNTY": "Staten Island",
        "\tbronx ": "Bronx", "Jersey": None, "": None, None: None,
    }
    assert values(c.clean_borough, cases) == list(cases.values())
    filled = [v or "UNKNOWN or CITYWIDE" for v in cases.values()]
    assert values(lambda v: c.clean_borough(v, c.CITYWIDE), cases) == filled


def test_trimming_covers_all_white_space(values):
    assert values(c.trim_all, ["\t a b \r\n", "　x ", "   ", None]) == ["a b", "x", "", None]
    assert values(c.blank_to_null, ["  ", "\t\n", "", " x ", None]) == [None, None, None, "x", None]
    assert values(c.normalize_token, ["open", " Open\n", "CLOSED", None]) == ["OPEN", "OPEN", "CLOSED", None]


def test_clock_padding(values):
    assert values(c.pad_clock, ["9:05", "09:05", "9:5", "12:00", "9:05\n", None]) == [
        "09:05", "09:05", "9:5", "12:00", "9:05\n", None,
    ]


def test_date_and_clock(spark):
    rows = [(dt.date(2021, 3, 4), "9:05"), (dt.date(2021, 3, 4), "23:59"), (dt.date(2021, 3, 4), None), (None, "1:00")]
    df = spark.createDataFrame(rows, "d date, t string")
    got = [r[0] for r in df.select(c.date_and_clock(F.col("d"), F.col("t"))).collect()]
    assert got == [dt.datetime(2021, 3, 4, 9, 5), dt.datetime(2021, 3, 4, 23, 59), None, None]


@pytest.mark.parametrize("bad", ["25:00", "noon", "12:60", "9:05\n"])
def test_bad_clock_fails_unless_lenient(spark, bad):
    df = spark.createDataFrame([(dt.date(2021, 3, 4), bad)], "d date, t string")
    with pytest.raises(PySparkException):
        df.select(c.date_and_clock(F.col("d"), F.col("t"))).collect()
    assert df.select(c.date_and_clock(F.col("d"), F.col("t"), strict=False)).collect()[0][0] is None


def test_bad_casts_fail_unless_lenient(values):
    for strict_fn, lenient_fn in (
        (c.to_timestamp, lambda v: c.to_timestamp(v, False)),
        (c.to_numeric, lambda v: c.to_numeric(v, False)),
        (c.zero_to_null, lambda v: c.zero_to_null(v, False)),
    ):
        with pytest.raises(PySparkException):
            values(strict_fn, ["nonsense"])
        assert values(lenient_fn, ["nonsense"]) == [None]


def test_decimals_keep_nine_places(values):
    assert values(c.to_numeric, ["40.7128", "-73.123456789", "0"]) == [
        Decimal("40.712800000"), Decimal("-73.123456789"), Decimal("0E-9"),
    ]
    assert values(c.zero_to_null, ["0", "0.0", "-0.000", "40.5", None]) == [None, None, None, Decimal("40.500000000"), None]


def test_members_and_fills(values, spark):
    boroughs = ["UNKNOWN or CITYWIDE", "Queens", None]
    assert values(c.known_borough, boroughs) == ["UNKNOWN", "Queens", "UNKNOWN"]
    assert values(lambda v: c.known_borough(v, False), boroughs) == ["UNKNOWN", "Queens", None]
    assert values(c.known_zip, ["10001", None]) == ["10001", "UNKNOWN"]
    rows = [("10001", "2", "Bronx", "Queens"), (None, "2", None, "Queens"), (None, "99999", None, None), ("99999", "2", None, None)]
    df = spark.createDataFrame(rows, "z string, dz string, b string, db string")
    got = df.select(c.fill_zip(F.col("z"), F.col("dz")), c.fill_borough(F.col("b"), F.col("db"))).collect()
    assert [tuple(r) for r in got] == [
        ("10001", "Bronx"), ("2", "Queens"), (None, "UNKNOWN or CITYWIDE"), (None, "UNKNOWN or CITYWIDE"),
    ]

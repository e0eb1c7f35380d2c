import datetime as dt
import hashlib

from pyspark.sql import functions as F

from recordloom.functions import calendar as cal
from recordloom.functions.keys import surrogate_key


def test_surrogate_key_text(spark):
    rows = [("a", 1, dt.date(2024, 1, 2)), (None, None, None), ("", 0, dt.date(1999, 12, 31))]
    got = [r[0] for r in spark.createDataFrame(rows, "s string, n bigint, d date").select(surrogate_key("s", "n", "d")).collect()]
    gap = "_dbt_utils_surrogate_key_null_"
    texts = ["a-1-2024-01-02", f"{gap}-{gap}-{gap}", "-0-1999-12-31"]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_key_collisions_are_kept(spark):
    rows = [("a-b", "c"), ("a", "b-c")]
    got = [r[0] for r in spark.createDataFrame(rows, "x string, y string").select(surrogate_key("x", "y")).collect()]
    assert got[0] == got[1]


def _nth(year, month, weekday, n):
    days = [d for d in range(1, 32) if _valid(year, month, d) and dt.date(year, month, d).weekday() == weekday]
    return dt.date(year, month, days[n])


def _valid(year, month, day):
    try:
        dt.date(year, month, day)
    except ValueError:
        return False
    return True


def test_every_day_of_forty_years(spark):
    holidays = set()
    for y in range(1990, 2031):
        holidays |= {dt.date(y, m, d) for m, d in ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25))}
        holidays |= {_nth(y, 1, 0, 2), _nth(y, 2, 0, 2), _nth(y, 5, 0, -1), _nth(y, 9, 0, 0), _nth(y, 10, 0, 1), _nth(y, 11, 3, 3)}
    days = spark.sql("SELECT explode(sequence(DATE '1990-01-01', DATE '2030-12-31')) AS d")
    rows = days.select("d", *cal.calendar_columns(F.col("d"))).collect()
    assert len(rows) == 14975
    for r in rows:
        d = r.d
        assert (r.year, r.month, r.day_of_month) == (d.year, d.month, d.day)
        assert r.day_of_week == d.isoweekday() % 7 + 1
        assert (r.month_name, r.day_name) == (d.strftime("%B"), d.strftime("%A"))
        assert r.is_weekend == (d.weekday() >= 5)
        assert r.is_holiday == (d in holidays), d


def test_time_bands(values):
    bands = values(cal.time_band, [*range(-1, 25), None], "bigint")
    expected = ["Unknown"] + ["Night"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 6 + ["Evening"] * 6 + ["Unknown", "Unknown"]
    assert bands == expected
    assert values(cal.hour_of, [dt.datetime(2024, 1, 1, 23, 59), None], "timestamp") == [23, None]

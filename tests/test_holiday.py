import datetime as dt

from pyspark.sql import functions as F

from tripcast.functions.calendar import holiday_calendar, is_us_holiday

HOLIDAYS = ["2013-01-01", "2013-01-21", "2013-02-18", "2013-05-27", "2013-07-04", "2013-09-02",
            "2013-10-14", "2013-11-11", "2013-11-28", "2013-12-25",
            "2011-12-26",   # Christmas on a Sunday, observed Monday
            "2010-12-31",   # New Year 2011 on a Saturday, observed Friday before
            "2021-06-18",   # Juneteenth on a Saturday
            "2015-07-03"]   # Independence Day on a Saturday
NOT_HOLIDAYS = ["2013-01-02", "2013-05-20", "2013-11-21", "2020-06-19", "2013-12-24", "2013-07-05"]


def test_rule(spark):
    days = [(dt.date.fromisoformat(d), 1) for d in HOLIDAYS] + [(dt.date.fromisoformat(d), 0) for d in NOT_HOLIDAYS]
    df = spark.createDataFrame(days, "d date, expected int")
    bad = df.filter(is_us_holiday(F.col("d")) != F.col("expected")).collect()
    assert bad == []


def test_calendar_counts(spark):
    df = spark.createDataFrame([(dt.date(2013, 1, 1),), (dt.date(2013, 12, 31),)], "day date")
    cal = holiday_calendar(df)
    assert cal.count() == 365
    assert cal.filter("is_holiday = 1").count() == 10

"""Report clock and day arithmetic, at the edges of months and days."""

from datetime import date, datetime

import pytest

from reachbook import AsOf
from reachbook.functions import calendar
from reachbook.operators import filters

# moment, yesterday, month start, prior month end, month end
CASES = [
    ("2024-01-30 12:00:00", (2024, 1, 29), (2024, 1, 1), (2023, 12, 31), (2024, 1, 31)),
    ("2024-03-01 00:00:00", (2024, 2, 29), (2024, 2, 1), (2024, 1, 31), (2024, 2, 29)),
    ("2023-03-01 23:59:59", (2023, 2, 28), (2023, 2, 1), (2023, 1, 31), (2023, 2, 28)),
    ("2024-01-01 10:00:00", (2023, 12, 31), (2023, 12, 1), (2023, 11, 30), (2023, 12, 31)),
    ("2024-01-02 00:00:00", (2024, 1, 1), (2024, 1, 1), (2023, 12, 31), (2024, 1, 31)),
    ("2024-12-31 23:59:00", (2024, 12, 30), (2024, 12, 1), (2024, 11, 30), (2024, 12, 31)),
]


@pytest.mark.parametrize("moment, yesterday, month_start, prior_month_end, month_end", CASES)
def test_bounds(spark, moment, yesterday, month_start, prior_month_end, month_end):
    as_of = AsOf.at(moment)
    expected = [date(*d) for d in (yesterday, month_start, prior_month_end, month_end)]
    assert [as_of.yesterday, as_of.month_start, as_of.prior_month_end, as_of.month_end] == expected
    assert as_of.today == date.fromisoformat(moment[:10])
    assert as_of.month_end_key == expected[3].strftime("%Y%m%d")
    day = spark.createDataFrame([(as_of.yesterday,)], "d date")
    row = day.select(
        calendar.first_of_month("d"),
        calendar.prior_month_end("d"),
        calendar.month_end("d"),
        calendar.day_key(calendar.month_end("d")),
        calendar.day_after(calendar.day_before("d")),
    ).first()
    assert list(row) == [*expected[1:], as_of.month_end_key, as_of.yesterday]


def test_cutoff_keeps_the_time_of_day(spark):
    """A date of yesterday passes; a later moment of yesterday does not."""
    as_of = AsOf.at("2024-03-10 12:00:00")
    rows = [
        (datetime(2024, 2, 29, 23, 59),), (datetime(2024, 3, 1),), (datetime(2024, 3, 9, 11, 59),),
        (datetime(2024, 3, 9, 12),), (datetime(2024, 3, 9, 12, 0, 1),), (datetime(2024, 3, 10),),
    ]
    moments = spark.createDataFrame(rows, "pt timestamp_ntz")
    kept = [r.pt for r in filters.month_to_date(moments, as_of).collect()]
    assert kept == [date(2024, 3, 1), date(2024, 3, 9), date(2024, 3, 9)]
    dates = spark.createDataFrame([(date(2024, 2, 29),), (date(2024, 3, 9),), (date(2024, 3, 10),)], "pt date")
    assert [r.pt for r in filters.month_to_date(dates, as_of).collect()] == [date(2024, 3, 9)]


def test_snapshot_window_includes_the_prior_month_end(spark):
    as_of = AsOf.at("2024-03-10 12:00:00")
    days = [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 9), date(2024, 3, 10)]
    frame = spark.createDataFrame([(d,) for d in days], "ReportDate date")
    assert [r.ReportDate for r in filters.snapshot_window(frame, as_of).collect()] == days[1:3]


def test_now_is_told_by_the_zone(spark):
    from datetime import datetime, timedelta, timezone

    def near(moment, hours):
        there = datetime.now(timezone(timedelta(hours=hours))).replace(tzinfo=None)
        return abs(there - moment) < timedelta(minutes=1)

    assert near(AsOf.now("Asia/Jakarta").moment, 7)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
        assert near(AsOf.now().moment, 14)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)

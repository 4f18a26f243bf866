"""The report clock and whole-day arithmetic."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """The moment a report is taken.

    Every bound is derived from this one moment, so a report that starts just
    before midnight cannot mix two calendar days.
    """

    moment: datetime

    @classmethod
    def now(cls, zone: str | None = None) -> AsOf:
        """The present moment on the clock of a zone such as Asia/Jakarta; by
        default of the session's zone, in which its timestamps are read."""
        if zone:
            return cls(datetime.now(ZoneInfo(zone)).replace(tzinfo=None))
        session = SparkSession.getActiveSession()
        if session is None:
            return cls(datetime.now())
        return cls(session.range(1).select(F.current_timestamp().cast("timestamp_ntz")).first()[0])

    @classmethod
    def at(cls, text: str) -> AsOf:
        return cls(datetime.fromisoformat(text))

    @property
    def cutoff(self) -> datetime:
        """One day before the moment, time of day kept: the latest data used."""
        return self.moment - timedelta(days=1)

    @property
    def today(self) -> date:
        return self.moment.date()

    @property
    def yesterday(self) -> date:
        return self.cutoff.date()

    @property
    def month_start(self) -> date:
        return self.yesterday.replace(day=1)

    @property
    def prior_month_end(self) -> date:
        return self.month_start - timedelta(days=1)

    @property
    def month_end(self) -> date:
        some_day_next_month = self.month_start + timedelta(days=31)
        return some_day_next_month.replace(day=1) - timedelta(days=1)

    @property
    def month_end_key(self) -> str:
        return self.month_end.strftime("%Y%m%d")


def first_of_month(day: str | Column) -> Column:
    return F.trunc(day, "MM")


def prior_month_end(day: str | Column) -> Column:
    return F.last_day(F.add_months(day, -1))


def month_end(day: str | Column) -> Column:
    return F.last_day(day)


def day_before(day: str | Column) -> Column:
    return F.date_sub(day, 1)


def day_after(day: str | Column) -> Column:
    return F.date_add(day, 1)


def day_key(day: str | Column) -> Column:
    """The compact text form used by month-end snapshot keys."""
    return F.date_format(day, "yyyyMMdd")

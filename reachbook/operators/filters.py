"""Row filters of the three inputs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachbook.functions.calendar import AsOf
from reachbook.functions.classify import STATUS_NORMAL, STATUS_WRITTEN_OFF
from reachbook.sources.tables import as_stored


def _days_up_to_cutoff(df: DataFrame, column: str, first: date, as_of: AsOf) -> DataFrame:
    """Rows from a day up to the cutoff, with the column reduced to its day.

    A date counts as its midnight, so yesterday always passes. A column that
    keeps the time of day is compared with the cutoff itself. Both forms leave
    plain column-to-literal bounds, which reach the file scan.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return df.where(F.col(column).between(F.lit(first), F.lit(as_of.yesterday)))
    bounds = [F.lit(str(bound)).cast(kind) for bound in (first, as_of.cutoff)]
    return df.where(F.col(column).between(*bounds)).withColumn(column, F.col(column).cast("date"))


def month_to_date(activity: DataFrame, as_of: AsOf) -> DataFrame:
    return _days_up_to_cutoff(activity, "pt", as_of.month_start, as_of)


def snapshot_window(loans: DataFrame, as_of: AsOf) -> DataFrame:
    """The month's snapshots and the last one before it, which serves day 1."""
    return _days_up_to_cutoff(loans, "ReportDate", as_of.prior_month_end, as_of)


def later(df: DataFrame, column: str, as_of: AsOf) -> DataFrame:
    """Rows that a report of an earlier moment did not see yet."""
    kind = df.schema[column].dataType
    seen = as_of.yesterday if isinstance(kind, T.DateType) else F.lit(str(as_of.cutoff)).cast(kind)
    return df.where(F.col(column) > F.lit(seen))


def month_end_snapshot(areas: DataFrame, as_of: AsOf) -> DataFrame:
    return areas.where(F.col("SK_Time") == as_of.month_end_key)


def near_month_end(areas: DataFrame, as_of: AsOf) -> DataFrame:
    """Rows of the areas as stored that hold all those of the month end, by a
    test that reaches the files: text that may be padded, or a number."""
    key, kind = F.col("SK_Time"), areas.schema["SK_Time"].dataType
    if isinstance(kind, T.IntegralType):
        return areas.where(key == int(as_of.month_end_key))
    return areas.where(key.startswith(as_of.month_end_key)) if kind == T.StringType() else areas


def _listed(column: str, values: Sequence[str], stored: bool) -> Column:
    """One of the values. On a conformed table also by a test of the text as
    stored, which files understand: equal up to trailing blanks, it starts alike."""
    exact = F.col(column).isin(*values)
    if not stored or not values:
        return exact
    raw = F.col(as_stored(column))
    return reduce(or_, [raw.startswith(value) for value in values], raw.isNull()) & exact


def in_channels(channels: Sequence[str], stored: bool = False) -> Column:
    return _listed("agent_type", channels, stored)


def in_products(products: Sequence[str], stored: bool = False) -> Column:
    return _listed("product", products, stored)


def positive_dpd() -> Column:
    """Assigned days overdue is text; anything but '0' and negatives passes."""
    return (F.col("assigned_dpd") != "0") & (F.substring("assigned_dpd", 1, 1) != "-")


def status_normal(stored: bool = False) -> Column:
    return _listed("DefaultStatus", [STATUS_NORMAL], stored)


def not_written_off(stored: bool = False) -> Column:
    """An unknown status is dropped too."""
    exact = F.col("DefaultStatus") != STATUS_WRITTEN_OFF
    if not stored:
        return exact
    raw = F.col(as_stored("DefaultStatus"))
    return (raw.isNull() | (raw != STATUS_WRITTEN_OFF)) & exact

"""The channel report from a state that is carried from day to day.

What the report needs of messages and of the loan book is one small row per
agreement and day, made of minima and maxima. So those rows can be kept: each
day adds its own, late rows add theirs to the day they belong to, and the report
merges them. Adding the same rows twice changes nothing, so a day that failed
half way is simply added again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reachbook.campaign import Campaign
from reachbook.functions.calendar import AsOf
from reachbook.operators import filters
from reachbook.plans import report

_TABLES = {"messages": report.message_partials, "loans": report.loan_partials}
_MERGED = {"messages": report.merged_messages, "loans": report.merged_loans}


def add(campaign: Campaign, folder: str, *, after: AsOf | None = None) -> None:
    """Add the campaign's month to date, or what came up to its moment after an
    earlier one: of tables stored by day, only the new days are read.

    For late rows, pass a campaign that holds just those and leave `after` out.
    """
    rows = {"messages": campaign.messages, "loans": campaign.snapshots}
    if after:
        rows = {
            "messages": filters.month_to_date(filters.later(campaign.activity, "pt", after), campaign.as_of),
            "loans": filters.snapshot_window(filters.later(campaign.loans, "ReportDate", after), campaign.as_of),
        }
    for name, partials in _TABLES.items():
        partials(campaign, rows[name]).write.partitionBy("day").mode("append").parquet(f"{folder}/{name}")


def compact(spark: SparkSession, campaign: Campaign, folder: str, into: str) -> None:
    """Write the state anew with one row per agreement and day, in another folder."""
    for name, merged in _MERGED.items():
        merged(campaign, spark.read.parquet(f"{folder}/{name}")).write.partitionBy("day").parquet(f"{into}/{name}")


def channel_report(campaign: Campaign, folder: str) -> DataFrame:
    """The channel report of the campaign's moment. Its activity and loan book are
    not read; the state must hold every day from the last one of the month before."""
    spark, as_of = campaign.areas.sparkSession, campaign.as_of
    messages, loans = (spark.read.parquet(f"{folder}/{name}") for name in _TABLES)
    return report.report_of_days(
        campaign,
        report.merged_loans(campaign, loans.where(loans.day.between(as_of.prior_month_end, as_of.yesterday))),
        report.merged_messages(campaign, messages.where(messages.day.between(as_of.month_start, as_of.yesterday))),
    )

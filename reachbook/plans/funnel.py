"""Message funnel: every message with its area, instalment and run outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.campaign import Campaign
from reachbook.functions import classify
from reachbook.functions.calendar import day_after
from reachbook.operators import filters
from reachbook.operators.lookups import AREA_ORDER, area_lookup
from reachbook.plans.outcomes import unique_installments

# Outcome columns a message takes over from the run of its instalment.
OUTCOME = ("newSR", "TotalOSPrincipal", "max__pt_1", "DPD_Max_2")
MESSAGE = (
    "agreementno", "assigned_dpd", "activity_date", "agent_id", "agent_type", "product", "disposition",
    "contact_number", "Grouped_Disposition", "persona_name", "contact_type", "pt",
)


def funnel_messages(campaign: Campaign) -> DataFrame:
    """Messages of the reported channels and products, agreement number cleaned."""
    return (
        campaign.messages.where(
            filters.in_products(campaign.products, stored=True)
            & filters.in_channels(campaign.message_channels, stored=True)
        )
        .withColumn("agreementno", F.col("agreement_key"))
        .withColumn("Grouped_Disposition", classify.grouped_disposition())
    )


def serving_loans(campaign: Campaign) -> DataFrame:
    """Instalment of each loan not written off, under the message day it serves."""
    return campaign.served_snapshots.where(filters.not_written_off(stored=True)).select(
        "agreement_key", day_after("ReportDate").alias("pt"), "angsuran"
    )


def with_outcome(df: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Attach run outcomes stored under the clean agreement number, by
    instalment. An unknown instalment matches none."""
    right = outcomes.selectExpr("agreementno as _agreement", "angsuran as _instalment", *OUTCOME)
    matches = (F.col("agreement_key") == F.col("_agreement")) & (F.col("angsuran") == F.col("_instalment"))
    return df.join(right, matches, "left").drop("_agreement", "_instalment")


def _meet(messages: DataFrame, loans: DataFrame) -> DataFrame:
    """Give messages what the loan book knows about their agreement and day.

    Area and outcome depend on the loan only, so they are attached to the loan
    rows first: the wide message rows move once, in this join.
    """
    return messages.join(loans, ["agreement_key", "pt"])


def funnel(campaign: Campaign) -> DataFrame:
    loans = area_lookup(serving_loans(campaign), campaign.served_areas)
    columns = [
        "agreementno", "assigned_dpd", "assigned_date", "activity_date", "agent_id", "agent_type", "product",
        "disposition", "contact_number", "Grouped_Disposition", "persona_name", "contact_type", "pt",
    ]
    return _meet(funnel_messages(campaign), loans).select(*columns, *AREA_ORDER, "angsuran")


def funnel_outcome(campaign: Campaign) -> DataFrame:
    """The funnel with run outcomes and the funnel form of the disposition."""
    placed = area_lookup(serving_loans(campaign), campaign.served_areas)
    loans = with_outcome(placed, unique_installments(campaign))
    return (
        _meet(funnel_messages(campaign), loans)
        .select(*MESSAGE, *AREA_ORDER, "angsuran", *OUTCOME)
        .withColumn("Disposition_NEW", classify.funnel_outcome())
    )


def funnel_stages(campaign: Campaign) -> DataFrame:
    """The funnel with one flag per stage a message can reach."""
    return funnel_outcome(campaign).withColumns(classify.stage_columns())

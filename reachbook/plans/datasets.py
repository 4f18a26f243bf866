"""Every dataset under its SQL name, for users who query by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from reachbook.campaign import Campaign
from reachbook.functions.classify import IVR, SMS, WHATSAPP
from reachbook.operators.lookups import numbered
from reachbook.plans import blast, funnel, outcomes, report, runs


def _contact_order(campaign: Campaign) -> DataFrame:
    """All contacts numbered in one window: a filter on the number shrinks it."""
    contacts = campaign.messages.select("agreementno", "agent_type", "pt")
    return numbered(contacts, ["agreementno", "pt"], [], "row_number")


DATASETS: dict[str, Callable[[Campaign], DataFrame]] = {
    "CTE": runs.run_outcome,
    "CTEE": runs.next_day_snapshot,
    "filtered_duplicate_yuris": _contact_order,
    "CTEEE": runs.next_day_contact,
    "CTEEEE": outcomes.grace_over,
    "newSR": outcomes.graced,
    "SR0": outcomes.graced,
    "SR01": outcomes.pending,
    "SR1": outcomes.successful,
    "UNIK_CTR_INSTALLMENT": outcomes.unique_installments,
    "UNIK_CTR": outcomes.ordered_agreements,
    "BLAST": blast.blast,
    "BLAST1": blast.blast_enriched,
    "BLAST2": blast.ordered_blasts,
    "FUNNEL": funnel.funnel,
    "FUNNEL1": funnel.funnel_outcome,
    "FUNNEL2": funnel.funnel_stages,
    "SRMEDIA": report.media,
    "SRWA": lambda c: report.channel_media(c, WHATSAPP),
    "SRWAPARTISI": lambda c: report.ranked_media(c, WHATSAPP),
    "SRIVR": lambda c: report.channel_media(c, IVR),
    "SRIVRPARTISI": lambda c: report.ranked_media(c, IVR),
    "SRSMS": lambda c: report.channel_media(c, SMS),
    "SRSMSPARTISI": lambda c: report.ranked_media(c, SMS),
    "BASE_SRMEDIA": report.best_media,
    "channel_report": report.channel_report,
}


def register_views(campaign: Campaign) -> list[str]:
    """Register a temporary view per dataset in the campaign's session."""
    for name, plan in DATASETS.items():
        plan(campaign).createOrReplaceTempView(name)
    return list(DATASETS)

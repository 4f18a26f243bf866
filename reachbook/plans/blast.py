"""Blast report: runs split by whether the customer was reached."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.campaign import Campaign
from reachbook.operators.lookups import first_of_group, numbered, numbered_in_parts
from reachbook.plans.outcomes import first_outcomes, unique_installments
from reachbook.plans.runs import judged

ORDER = (
    "agreementno", "product", "angsuran", "min__pt", "max__pt", "Grouped_Disposition", "DPD_Min", "DPD_Max",
    "DPD_Max_1", "TotalOSPrincipal", "Installment Amount Latest", "DefaultStatus", "Provinsi", "Kab", "Kec",
    "Desa", "SR", "rownum",
)
OUTCOME = ("newSR", "max__pt_1", "DPD_Max_2", "agent_type")
_GROUP = ["agreementno", "angsuran"]
_CONTACTED_FIRST = ["Grouped_Disposition asc nulls first"]
# The first columns of a blast, in order.
_PARTS = ("product", "min__pt", "max__pt", "DPD_Min", "DPD_Max", "DPD_Max_1")


def blast(campaign: Campaign) -> DataFrame:
    """Run outcomes per contact group, for the message channels only."""
    return judged(campaign, by_contact=True).select(*[f"`{c}`" for c in ORDER])


def _with_outcome(blasts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Match by agreement and instalment; the product plays no part."""
    right = outcomes.selectExpr("agreementno as _agreement", "angsuran as _instalment", *OUTCOME)
    matches = (F.col("agreementno") == F.col("_agreement")) & (F.col("angsuran") == F.col("_instalment"))
    return blasts.join(right, matches, "left").drop("_agreement", "_instalment")


def blast_enriched(campaign: Campaign) -> DataFrame:
    """Blasts with the final outcomes of their agreement and instalment."""
    return _with_outcome(blast(campaign), unique_installments(campaign))


def ordered_blasts(campaign: Campaign) -> DataFrame:
    """Enriched blasts numbered per agreement and instalment, contacted first, as
    a plain window: a filter on the number shrinks it to the picks."""
    return numbered(blast_enriched(campaign), _GROUP, _CONTACTED_FIRST, "row_num", skip=["Grouped_Disposition"])


def ranked_blasts(campaign: Campaign) -> DataFrame:
    """The same rows and numbers, for reading all of them: numbered in parts, one
    per product, run and readings."""
    parts = [*_CONTACTED_FIRST, *[f"{c} asc nulls first" for c in _PARTS]]
    return numbered_in_parts(
        blast_enriched(campaign), _GROUP, parts, "row_num", skip=["Grouped_Disposition", *_PARTS]
    )


def best_blasts(campaign: Campaign) -> DataFrame:
    """The first enriched blast of each agreement and instalment.

    All blasts of a group meet the same outcomes, so the first pair is the
    first blast with the first outcome: both sides shrink before they meet.
    """
    first_blast = first_of_group(blast(campaign), _GROUP, _CONTACTED_FIRST, "row_num", skip=["Grouped_Disposition"])
    return _with_outcome(first_blast, first_outcomes(campaign, list(OUTCOME))).select(*[f"`{c}`" for c in (*ORDER, *OUTCOME, "row_num")])

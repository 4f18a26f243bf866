"""Final run outcomes: success with the one-day grace rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachbook.campaign import Campaign
from reachbook.functions import classify
from reachbook.functions.calendar import day_after, day_before
from reachbook.operators.lookups import first_of_group, numbered, numbered_in_parts, snapshot_lookup
from reachbook.plans.runs import contacted_days, first_contacts, next_day_contact, run_spans, with_contact, with_key


def _is_today(campaign: Campaign):
    return F.col("max__pt_1") == F.lit(campaign.as_of.today)


def grace_over(campaign: Campaign) -> DataFrame:
    """Unsuccessful runs whose next day has passed."""
    return next_day_contact(campaign).where((F.col("SR") == 0) & ~_is_today(campaign))


def graced(campaign: Campaign) -> DataFrame:
    """Those runs with the grace rule applied."""
    return grace_over(campaign).withColumn("newSR", classify.grace_success())


def pending(campaign: Campaign) -> DataFrame:
    """Unsuccessful runs whose next day is today: no grace yet."""
    return next_day_contact(campaign).where((F.col("SR") == 0) & _is_today(campaign)).withColumn("newSR", F.col("SR"))


def successful(campaign: Campaign) -> DataFrame:
    """Runs that succeeded on the last message day."""
    return next_day_contact(campaign).where(F.col("SR") == 1).withColumn("newSR", F.col("SR"))


def unique_installments(campaign: Campaign) -> DataFrame:
    """Every run with its final outcome.

    The three branches above are disjoint and cover all runs, so one pass with
    one conditional replaces a union that would compute all runs three times.
    """
    return next_day_contact(campaign).withColumn("newSR", classify.final_success(campaign.as_of.today))


def outcome_branches(campaign: Campaign) -> DataFrame:
    """The same rows with the name of the branch each one belongs to."""
    branch = F.when(F.col("SR") == 1, "SR1").when(_is_today(campaign), "SR01").otherwise("SR0")
    return unique_installments(campaign).withColumn("branch", branch)


_BEST_FIRST = ["newSR desc nulls last"]
# The first columns of an outcome, in order.
_PARTS = ("product", "angsuran", "min__pt", "max__pt", "DPD_Min", "DPD_Max", "DPD_Max_1")


def ordered_agreements(campaign: Campaign) -> DataFrame:
    """Outcomes numbered per agreement, the best one first, as a plain window: a
    filter on the number shrinks it to the picks."""
    return numbered(unique_installments(campaign), ["agreementno"], _BEST_FIRST, "rn", skip=["newSR"])


def ranked_agreements(campaign: Campaign) -> DataFrame:
    """The same rows and numbers, for reading all of them: numbered in parts, one
    per product, instalment, run and readings."""
    parts = [*_BEST_FIRST, *[f"{c} asc nulls first" for c in _PARTS]]
    return numbered_in_parts(
        unique_installments(campaign), ["agreementno"], parts, "rn", skip=["newSR", *_PARTS]
    )


def unique_agreements(campaign: Campaign) -> DataFrame:
    """The best outcome of each agreement."""
    return first_of_group(
        unique_installments(campaign), ["agreementno"], _BEST_FIRST, "rn", skip=["newSR"]
    )


def _overdue_kinds(campaign: Campaign) -> DataFrame:
    """Per agreement and day at most three snapshots: one with unknown days
    overdue, one with none, and the one with the least of the others."""
    days = F.col("DaysOverDueTolerance")
    facts = campaign.served_snapshots.groupBy("agreement_key", "ReportDate").agg(
        F.max(days.isNull()).alias("unknown"),
        F.max(days == 0).alias("clear"),
        F.min(F.when(days != 0, days)).alias("least"),
    )
    kinds = (
        "explode(array(struct(unknown as held, cast(null as int) as days), struct(clear as held, 0 as days),"
        " struct(least is not null as held, least as days))) as kind"
    )
    return (
        facts.selectExpr("agreement_key", "ReportDate", kinds)
        .where("kind.held")
        .selectExpr("agreement_key", "ReportDate", "kind.days as DaysOverDueTolerance")
    )


def _least_principal(campaign: Campaign) -> DataFrame:
    principal = F.col("TotalOSPrincipal")
    return campaign.served_snapshots.groupBy("agreement_key", "ReportDate").agg(
        F.when(~F.max(principal.isNull()), F.min(principal)).alias("TotalOSPrincipal")
    )


def first_outcomes(campaign: Campaign, columns: list[str]) -> DataFrame:
    """The first outcome per stored agreement number and instalment, ordered by
    the given columns out of newSR, TotalOSPrincipal, max__pt_1, DPD_Max_2 and
    agent_type, lowest and NULL first. newSR must come first.

    A pick needs no copies: readings it does not show are left out, and doubled
    snapshots shrink to the few that can decide it, on the layout its lookups
    use. So an agreement with any number of snapshots yields a handful of rows.
    """
    runs = with_key(run_spans(campaign))
    if "TotalOSPrincipal" in columns:
        principal = {"TotalOSPrincipal": "TotalOSPrincipal"}
        runs = snapshot_lookup(runs, _least_principal(campaign), day_before("min__pt"), principal)
    kinds, days = _overdue_kinds(campaign), "DaysOverDueTolerance"
    on_last = snapshot_lookup(runs, kinds, F.col("max__pt"), {"DPD_Max_1": days})
    after = snapshot_lookup(on_last, kinds, day_after("max__pt"), {"DPD_Max_2": days})
    after = after.withColumns({"SR": classify.run_success("DPD_Max_1"), "max__pt_1": day_after("max__pt")})
    contacts = first_contacts(campaign) if "agent_type" in columns else contacted_days(campaign)
    final = with_contact(after, contacts).withColumn("newSR", classify.final_success(campaign.as_of.today))
    shown = final.select("agreementno", "angsuran", *columns)
    return first_of_group(shown, ["agreementno", "angsuran"], [], "_first").drop("_first")

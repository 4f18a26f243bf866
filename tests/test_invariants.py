"""Properties that must hold between datasets."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from reachbook.plans import funnel, outcomes, report
from reachbook.plans.runs import next_day_contact
from tests.helpers import spark_rows


@pytest.fixture(scope="module")
def campaign(spark):
    return entry_points.campaign(spark, "/root/testdata/sf0.01")


def test_branches_are_disjoint_and_cover_all_runs(campaign):
    parts = [outcomes.graced(campaign), outcomes.pending(campaign), outcomes.successful(campaign)]
    _, together = spark_rows(parts[0].union(parts[1]).union(parts[2]))
    _, single_pass = spark_rows(outcomes.unique_installments(campaign))
    assert together == single_pass
    assert sum(p.count() for p in parts) == next_day_contact(campaign).count()


def test_grace_only_adds_success(campaign):
    runs = outcomes.unique_installments(campaign)
    assert runs.where("newSR < SR or newSR is null or newSR not in (0, 1)").count() == 0


def test_one_best_message_per_channel_and_instalment(campaign):
    groups = funnel.funnel_outcome(campaign).select("agent_type", "agreementno", "angsuran").distinct().count()
    best = report.best_media(campaign)
    assert best.count() == groups
    total = report.channel_report(campaign).agg(F.sum("agreementno")).first()[0]
    assert total == groups


def test_channel_picks_make_up_the_whole(campaign):
    _, together = spark_rows(report.best_media(campaign))
    united = None
    for channel, (rank, number) in report.CHANNEL_COLUMNS.items():
        one = report.best_of_channel(campaign, channel).withColumnsRenamed({rank: report.RANK, number: report.NUMBER})
        united = one if united is None else united.union(one)
    assert spark_rows(united)[1] == together


@pytest.mark.parametrize("channel", list(report.CHANNEL_COLUMNS))
def test_first_of_the_ranking_is_the_pick(campaign, channel):
    _, number = report.CHANNEL_COLUMNS[channel]
    ranked = report.ranked_media(campaign, channel).where(F.col(number) == 1)
    assert spark_rows(ranked) == spark_rows(report.best_of_channel(campaign, channel))

"""Physical plans: what is pushed down, read once, and never done."""

import re

import pytest

import __spark_entry__ as entry_points
from pyspark.sql import functions as F

from reachbook import AsOf, Campaign
from reachbook.plans import blast, funnel, outcomes, report, runs
from tests.helpers import random_tables, write_tables

AS_OF = AsOf.at("2024-03-20 12:00:00")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The three tables as files, partitioned the way a deployment would."""
    folder = tmp_path_factory.mktemp("stored")
    paths = write_tables(folder, *random_tables(1, AS_OF.moment))
    spark.read.parquet(paths["loans"]).write.partitionBy("ReportDate").parquet(f"{folder}/loans_by_day")
    return Campaign.from_parquet(spark, AS_OF, paths["activity"], f"{folder}/loans_by_day", paths["areas"])


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry_points.QUERIES))
def test_no_python_workers_and_no_cross_join(stored, name):
    plan = plan_of(entry_points.QUERIES[name](stored))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_report_reads_each_table_once_and_joins_only_areas(stored):
    plan = plan_of(report.channel_report(stored))
    assert plan.count("FileScan") == 3
    assert len(re.findall(r"\w+Join ", plan)) == 1
    # Two shuffles per large table (the second one shared), one for areas, one for the report.
    assert plan.count("Exchange hashpartitioning") == 5


def test_date_bounds_reach_the_scan(stored):
    plan = plan_of(report.channel_report(stored))
    assert "GreaterThanOrEqual(pt,2024-03-01), LessThanOrEqual(pt,2024-03-19)" in plan
    bounds = r"ReportDate#\d+ >= 2024-02-29[^\]]*ReportDate#\d+ <= 2024-03-19"
    assert re.search(rf"PartitionFilters: \[[^\]]*{bounds}", plan)
    assert "ReadSchema: struct<agreementno:string,product:string,assigned_dpd:string,agent_type:string," in plan


def test_first_of_group_shrinks_before_the_shuffle(stored):
    plan = plan_of(outcomes.unique_agreements(stored))
    assert re.search(
        r"WindowGroupLimit.*Final.*\n.*Sort.*\n.*Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", plan
    )


def test_best_messages_shrink_before_each_shuffle(stored):
    """Whole messages move in two shuffles, both behind a partial minimum; the
    join with the loan book reads the first one's layout."""
    plan = plan_of(report.best_media(stored, ["IVR"]))
    shuffles = re.findall(r"Exchange hashpartitioning.*\n.*", plan)
    wide = [s for s in shuffles if "persona_name" in s or "struct(message" in s]
    assert len(wide) == 2
    assert all("partial_min(CASE WHEN" in s for s in wide)


def test_run_spans_join_on_the_layout_of_the_pre_aggregate(stored):
    """Messages: one shuffle for the daily aggregate and none for the join."""
    # Cut off the unused copy that partition pruning keeps for a broadcast join.
    plan = plan_of(runs.run_spans(stored)).split("SubqueryAdaptiveBroadcast")[0]
    assert plan.count("Exchange hashpartitioning") == 3


def test_month_end_reaches_the_area_scan(stored, spark):
    areas = stored.month_end_areas
    assert "StringStartsWith(SK_Time,20240331)" in plan_of(areas)
    padded = spark.createDataFrame([("A1", "20240331  "), ("A2", "202403310"), ("A3", None)], "AgreementNo string, SK_Time string")
    numbers = spark.createDataFrame([("A1", 20240331), ("A2", 20240330)], "AgreementNo string, SK_Time int")
    for kept in (padded, numbers):
        for name in ("Provinsi", "Kab", "Kec", "Desa"):
            kept = kept.withColumn(name, F.lit("x"))
        kept = kept.withColumn("SubCGID", F.lit(1))
        campaign = Campaign.of(stored.activity, stored.loans, kept, AS_OF)
        assert [r.AgreementNo for r in campaign.month_end_areas.collect()] == ["A1"]


@pytest.mark.parametrize(
    ("plan", "pushed"),
    [
        (runs.qualified_messages, "StringStartsWith(agent_type,WHATSAPP)"),
        (runs.qualified_messages, "StringStartsWith(product,CAR)"),
        (runs.qualified_messages, "StringStartsWith(DefaultStatus,NM)"),
        (runs.run_spans, "StringStartsWith(agent_type,DIGITAL)"),
        (funnel.funnel, "Not(EqualTo(DefaultStatus,WO))"),
        (funnel.funnel, "StringStartsWith(product,MCY)"),
    ],
)
def test_text_filters_reach_the_scan(stored, spark, plan, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = plan_of(plan(stored))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any(pushed in filters for filters in re.findall(r"PushedFilters: \[.*", text))


def test_report_compiles_to_whole_stages(stored, spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        df = report.channel_report(stored)
        rows = df.collect()
        assert re.search(r"\*\(\d+\) HashAggregate", plan_of(df))
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
    assert sorted(map(str, rows)) == sorted(map(str, report.channel_report(stored).collect()))


def test_stored_partitions_do_not_copy_plans(stored):
    """Pruning by joins would double the text of a plan per join."""
    plan = plan_of(runs.next_day_contact(stored))
    assert plan.count("Exchange hashpartitioning") <= 25


def test_unused_columns_are_not_read(stored):
    plan = plan_of(runs.run_spans(stored))
    assert "ReadSchema: struct<agreementno:string,product:string,assigned_dpd:string,agent_type:string,pt:date>" in plan
    assert "TotalOSPrincipal" not in plan


@pytest.mark.parametrize(
    "plan",
    [
        runs.run_outcome, runs.next_day_snapshot, runs.next_day_contact, outcomes.unique_installments,
        outcomes.unique_agreements, blast.blast,
    ],
)
def test_runs_read_and_join_the_loan_book_once(stored, spark, plan):
    """However many days around a run they look up."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = plan_of(plan(stored))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in text.splitlines() if "FileScan" in line and "DaysOverDueTolerance" in line]
    assert len(scans) == 1 and "loans_by_day" in scans[0]
    assert len(re.findall(r"\w+Join .*_reported", text)) == 1


def test_copies_are_counted_before_they_move(stored):
    plan = plan_of(runs.run_outcome(stored))
    assert re.search(r"Exchange hashpartitioning\(agreementno.*_DaysOverDueTolerance.*\n.*HashAggregate.*partial_count", plan)

"""Filters before the shuffle, buckets, and the state carried from day to day."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from reachbook import AsOf, Campaign
from reachbook.operators.sideways import Bloom, key_filter
from reachbook.plans import increment, report, runs
from reachbook.sources.storage import BUCKETED_JOINS, store_bucketed, use_buckets
from tests.helpers import random_tables, spark_rows, write_tables

AS_OF = AsOf.at("2024-03-20 12:00:00")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(df) -> int:
    """Bytes that a query has written to shuffles."""
    df.collect()
    total = 0
    nodes = [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec":
                total += node.metrics().apply("shuffleBytesWritten").value()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
    return total


# Bloom filters.


@pytest.mark.parametrize("bloom", [Bloom(), Bloom(bits=6, hashes=1), Bloom(bits=12, hashes=4)])
def test_every_key_passes(spark, bloom):
    keys = spark.range(400).selectExpr("if(id % 9 = 0, null, concat('A', id)) as k")
    passes = key_filter(keys, "k", bloom)
    found = spark.range(4000).selectExpr("concat('A', id) as k", "id").withColumn("passes", passes("k"))
    assert found.where("id < 400 and id % 9 <> 0 and not passes").count() == 0
    assert spark.range(1).selectExpr("cast(null as string) as k").where(passes("k")).count() == 0
    if bloom.bits == 23:
        assert found.where("passes").count() < 360
    assert spark.range(5).selectExpr("string(id) as k").where(key_filter(keys.limit(0), "k", bloom)("k")).count() == 0


@pytest.mark.parametrize("name", ["d_next_day_contact", "d_blast", "d_funnel_outcome", "r_blast_best", "u_best_per_channel", "r_channel_report"])
def test_reports_are_the_same_without_unmessaged_agreements(spark, tmp_path, name):
    paths = write_tables(tmp_path, *random_tables(4, AS_OF.moment))
    rows = [spark_rows(entry_points.QUERIES[name](Campaign.from_parquet(spark, AS_OF, **paths, reduce=r))) for r in (None, Bloom(bits=8))]
    assert rows[0] == rows[1] and rows[0][1]


def test_a_filter_under_a_collation_is_left_out(spark, tmp_path):
    paths = write_tables(tmp_path, *random_tables(4, AS_OF.moment))
    campaign = Campaign.from_parquet(spark, AS_OF, **paths, collation="UTF8_LCASE", reduce=Bloom())
    assert campaign.served_snapshots is campaign.snapshots


@pytest.mark.parametrize("plan", [report.channel_report, runs.run_outcome])
def test_a_hundredth_of_the_agreements_messaged(spark, plan):
    activity = spark.range(200).selectExpr(
        "concat('A', id * 100) as agreementno", "'CAR' as product", "'1' as assigned_dpd", "cast(null as date) as assigned_date",
        "timestamp_ntz'2024-03-10 00:00:00' as activity_date", "'G' as agent_id", "'IVR' as agent_type", "'FAILED' as disposition",
        "'628' as contact_number", "'P' as persona_name", "'SELF' as contact_type", "1 as subcgid", "date'2024-03-10' as pt",
    )
    loans = spark.range(60_000).selectExpr(
        "concat('A', id div 3) as AgreementNo", "date_add(date'2024-03-09', cast(id % 3 as int)) as ReportDate",
        "cast(id % 7 as int) as angsuran", "'NM' as DefaultStatus", "cast(id % 2 as int) as DaysOverDueTolerance",
        "cast(xxhash64(id) % 1000 as decimal(18,2)) as TotalOSPrincipal", "cast(id as decimal(18,2)) as `Installment Amount Latest`",
        "'CAR' as Product",
    )
    areas = spark.range(20_000).selectExpr(
        "concat('A', id) as AgreementNo", "'P' as Provinsi", "concat('K', id) as Kab", "'C' as Kec", "'D' as Desa", "1 as SubCGID",
        "'20240331' as SK_Time",
    )
    full, reduced = (plan(Campaign.of(activity, loans, areas, AS_OF, reduce=r)) for r in (None, Bloom(bits=16)))
    before, after = shuffled(full), shuffled(reduced)
    assert spark_rows(full) == spark_rows(reduced) and full.count() > 0
    assert 10 * after < before, (before, after)


# Buckets.


@pytest.fixture
def bucketed(spark, tmp_path):
    paths = write_tables(tmp_path, *random_tables(2, AS_OF.moment))
    for name, day in (("activity", "pt"), ("loans", "ReportDate"), ("areas", None)):
        store_bucketed(spark.read.parquet(paths[name]), f"bucketed_{name}", 3, day=day, path=f"{tmp_path}/b_{name}", mode="overwrite")
    use_buckets(spark)
    yield (
        Campaign.from_catalog(spark, AS_OF, "bucketed_activity", "bucketed_loans", "bucketed_areas"),
        Campaign.from_parquet(spark, AS_OF, **paths),
    )
    for name in BUCKETED_JOINS:
        spark.conf.unset(name)
    for name in ("activity", "loans", "areas"):
        spark.sql(f"DROP TABLE bucketed_{name}")


def book_shuffles(text: str) -> list[str]:
    """Shuffles right above a scan of the loan book, before any join or aggregate."""
    found, lines = [], text.splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line and "DaysOverDueTolerance" in line:
            above = []
            for up in reversed(lines[:i]):
                if re.search(r"Join|Aggregate|Union", up):
                    break
                above.append(up)
            found += [x for x in above if "Exchange" in x]
    return found


@pytest.mark.parametrize("plan", [runs.run_outcome, runs.next_day_contact])
def test_buckets_are_joined_where_they_lie(bucketed, spark, plan):
    stored, plain = bucketed
    assert book_shuffles(plan_of(plan(plain)))
    text = plan_of(plan(stored))
    assert "Bucketed: true" in text and not book_shuffles(text)
    assert spark_rows(plan(stored)) == spark_rows(plan(plain))


@pytest.mark.parametrize("name", ["r_channel_report", "u_best_per_channel", "d_blast", "d_funnel_outcome", "w_rank_ivr"])
def test_buckets_give_the_same_rows(bucketed, name):
    stored, plain = bucketed
    assert spark_rows(entry_points.QUERIES[name](stored)) == spark_rows(entry_points.QUERIES[name](plain))


# The state.


def tables_over_a_month(seed: int):
    """Random tables spread over February and March, so that the month turns."""
    pick = random.Random(seed)
    activity, loans, areas = random_tables(seed, datetime(2024, 3, 6, 9))
    activity = [{**row, "late": pick.random() < 0.2} for row in activity]
    loans = [{**row, "late": pick.random() < 0.2} for row in loans]
    areas += [{**row, "SK_Time": "20240229"} for row in areas]
    return activity, loans, areas


@pytest.mark.parametrize("seed", [3, 8])
def test_a_state_and_one_day_equal_a_full_run(spark, tmp_path, seed):
    activity, loans, areas = tables_over_a_month(seed)
    days = sorted({r["pt"] for r in activity})
    state, before, lines = str(tmp_path / "state"), None, 0
    held: tuple[list, list] = ([], [])
    for number, day in enumerate(days):
        as_of = AsOf(datetime.combine(day + timedelta(days=1), datetime.min.time()) + timedelta(hours=9))
        here = tmp_path / str(number)
        here.mkdir()
        # Late rows arrive one day after their own; the full run sees what has arrived.
        known = [[r for r in rows if r[c] + timedelta(days=r["late"]) <= day] for rows, c in ((activity, "pt"), (loans, "ReportDate"))]
        paths = write_tables(here, *[[{k: v for k, v in r.items() if k != "late"} for r in rows] for rows in known], areas)
        campaign = Campaign.from_parquet(spark, as_of, **paths)
        increment.add(campaign, state, after=before)
        late = [[r for r in rows if r["late"] and r not in own and r[c] < day] for rows, own, c in zip(known, held, ("pt", "ReportDate"), strict=True)]
        if before and any(late):
            (here / "late").mkdir()
            paths = write_tables(here / "late", *[[{k: v for k, v in r.items() if k != "late"} for r in rows] for rows in late], areas)
            increment.add(Campaign.from_parquet(spark, as_of, **paths), state)
        held, before = tuple(known), as_of
        ours = spark_rows(increment.channel_report(campaign, state))
        assert ours == spark_rows(report.channel_report(campaign)), day
        lines += sum(ours[1].values())
    assert lines > 10
    # Adding a day again, or writing the state anew, changes nothing.
    increment.add(campaign, state)
    increment.compact(spark, campaign, state, str(tmp_path / "compact"))
    for folder in (state, str(tmp_path / "compact")):
        assert spark_rows(increment.channel_report(campaign, folder)) == spark_rows(report.channel_report(campaign))


def test_a_new_day_reads_its_own_partition(spark, tmp_path):
    paths = write_tables(tmp_path, *random_tables(1, AS_OF.moment))
    for name, day in (("activity", "pt"), ("loans", "ReportDate")):
        spark.read.parquet(paths[name]).where(f"{day} is not null").write.partitionBy(day).parquet(f"{tmp_path}/by_day/{name}")
    campaign = Campaign.from_parquet(spark, AS_OF, f"{tmp_path}/by_day/activity", f"{tmp_path}/by_day/loans", paths["areas"])
    from reachbook.operators import filters

    for table, day in ((campaign.activity, "pt"), (campaign.loans, "ReportDate")):
        rows = filters.later(table, day, AsOf.at("2024-03-19 12:00:00"))
        rows = (filters.month_to_date if day == "pt" else filters.snapshot_window)(rows, AS_OF)
        text = plan_of(rows)
        assert re.search(rf"PartitionFilters: \[[^\]]*{day}#\d+ > 2024-03-18", text)
        assert {r[0] for r in rows.select(F.date_format(day, "yyyy-MM-dd")).distinct().collect()} <= {"2024-03-19"}


def test_moments_are_cut_at_the_cutoff(spark):
    from reachbook.operators import filters

    df = spark.sql("select explode(sequence(timestamp_ntz'2024-03-18 00:00:00', timestamp_ntz'2024-03-20 00:00:00', interval 6 hours)) as pt")
    old, new = AsOf.at("2024-03-19 12:00:00"), AsOf.at("2024-03-20 12:00:00")
    every = df.where(F.col("pt") <= F.lit(str(new.cutoff)).cast("timestamp_ntz")).count()
    seen = df.where(F.col("pt") <= F.lit(str(old.cutoff)).cast("timestamp_ntz")).count()
    assert filters.month_to_date(filters.later(df, "pt", old), new).count() == every - seen

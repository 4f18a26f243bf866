"""Numbers by ranges: groups of any size, rows that differ late or not at all."""

import re
from statistics import median

import pytest
from pyspark.sql import functions as F

from reachbook.operators import lookups
from reachbook.plans import runs
from tests.helpers import spark_rows

N = 200_000


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture
def sixteen(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.mark.parametrize("block", [3, 10_000])
@pytest.mark.parametrize("partitions", [1, 16])
def test_same_numbers_as_the_window(spark, sixteen, monkeypatch, block, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    monkeypatch.setattr(lookups, "BLOCK", block)
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', if(id % 5 = 1, null, cast(id % 5 as string))) as k",
        "id % 4 as a",
        "if(id % 7 = 0, null, cast(id * 17 % 40 as string)) as t",
        "cast(id % 2 as decimal(18,2)) as `with blank`",
    )
    plain = lookups.numbered(df, ["k"], ["a desc nulls last"], "n", skip=["a"])
    ranged = lookups.numbered_by_ranges(df, ["k"], ["a desc nulls last"], "n", skip=["a"])
    assert ranged.dtypes == plain.dtypes
    assert rows(ranged, "k", "a", "t", "`with blank`", "n") == rows(plain, "k", "a", "t", "`with blank`", "n")


def test_no_rows(spark):
    assert lookups.numbered_by_ranges(spark.range(0), ["id"], ["id asc"], "n").collect() == []


@pytest.mark.parametrize("row", ["cast(id as string) as late", "cast(id % 10 as string) as late", "'same' as late"])
def test_a_hot_group_is_shared_out(sixteen, row):
    """One agreement in one minute: rows that differ in their last column, hardly, or not at all."""
    df = sixteen.range(N).selectExpr(
        "if(id % 100 = 0, concat('A', id % 900), 'hot') as k", "timestamp_ntz'2024-01-01 00:00:00' as t", "1 as same", row
    )
    found = lookups.numbered_by_ranges(df, ["k"], ["t asc"], "n")
    assert found.groupBy("k").agg(F.count("*"), F.count_distinct("n"), F.max("n")).where("k = 'hot'").first()[1:] == (198_000,) * 3
    ranged = lookups._ranged(df, ["k"], ["t asc", "same asc", "late asc"])
    sizes = [r["count"] for r in ranged.groupBy("_part").count().collect()]
    if sum(sizes) > 1000:
        assert len(sizes) >= 14 and max(sizes) <= 4 * median(sizes)
    else:  # copies: a few rows, dealt out in blocks afterwards
        assert sum(sizes) < 200 and row != "cast(id as string) as late"
    tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 4 * median(tasks)


def test_parts_and_counts_read_one_shuffle(sixteen):
    df = sixteen.range(5000).selectExpr("id % 3 as k", "id as v")
    found = lookups.numbered_by_ranges(df, ["k"], ["v desc"], "n")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("+- Exchange rangepartitioning") == 1
    assert len(re.findall(r"\+- ReusedExchange .*Exchange rangepartitioning", final)) == 1


def test_differing_ranges_fail(sixteen):
    """Where a session forbids to share a shuffle, no wrong number comes out."""
    sixteen.conf.set("spark.sql.exchange.reuse", "false")
    df = sixteen.range(30_000).selectExpr("id % 3 as k", "xxhash64(id) as v")
    try:
        found = lookups.numbered_by_ranges(df, ["k"], ["v desc"], "n")
        plain = lookups.numbered(df, ["k"], ["v desc"], "n")
        try:
            assert rows(found, "k", "v", "n") == rows(plain, "k", "v", "n")
        except Exception as error:
            assert "spark.sql.exchange.reuse" in str(error)
    finally:
        sixteen.conf.unset("spark.sql.exchange.reuse")


def test_an_agreement_with_many_runs(sixteen, tmp_path):
    from datetime import date

    from reachbook import AsOf, Campaign

    as_of = AsOf.at("2024-03-20 12:00:00")
    day = date(2024, 3, 10)
    activity = sixteen.createDataFrame(
        [("A1", "CAR", "1", "WHATSAPP", "READ", day), ("A2", "CAR", "1", "IVR", "FAILED", day)],
        "agreementno string, product string, assigned_dpd string, agent_type string, disposition string, pt date",
    )
    for name, kind in (("assigned_date", "date"), ("activity_date", "timestamp_ntz"), ("agent_id", "string"),
                       ("contact_number", "string"), ("persona_name", "string"), ("contact_type", "string"), ("subcgid", "int")):
        activity = activity.withColumn(name, F.lit(None).cast(kind))
    loans = sixteen.range(24).selectExpr(
        "if(id % 8 = 0, 'A2', 'A1') as AgreementNo", "date'2024-03-09' as ReportDate", "cast(id as int) as angsuran",
        "'NM' as DefaultStatus", "cast(id % 3 as int) as DaysOverDueTolerance", "cast(7 as decimal(18,2)) as TotalOSPrincipal",
        "cast(7 as decimal(18,2)) as `Installment Amount Latest`", "'CAR' as Product",
    )
    areas = sixteen.createDataFrame([("A1", "P", "K", "C", "D", 1, "20240331")], "AgreementNo string, Provinsi string, Kab string, Kec string, Desa string, SubCGID int, SK_Time string")
    campaign = Campaign.of(activity, loans, areas, as_of)
    assert spark_rows(runs.run_sequence(campaign)) == spark_rows(runs.run_outcome(campaign))

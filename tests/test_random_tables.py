"""Datasets on small random tables full of ties, fan-outs, NULLs and padding."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import duckdb_sql
from reachbook import AsOf, Campaign
from reachbook.plans import report, runs
from tests.helpers import STORED_TABLES, assert_same, random_tables, spark_rows, write_tables

MOMENTS = ["2024-03-20 12:00:00", "2024-03-01 00:00:00", "2024-01-05 23:59:00", "2023-03-04 08:30:00"]
NAMES = [
    "a_run_span_by_outcome", "d_run_outcome", "d_next_day_contact", "d_blast", "w_contact_dedup", "w_contact_sequence", "r_unique_agreements", "d_blast_enriched",
    "r_blast_best", "r_funnel_stages", "w_rank_whatsapp", "u_best_per_channel", "r_channel_report",
]


@pytest.fixture(scope="module", params=range(len(MOMENTS)), ids=MOMENTS)
def case(request, spark, tmp_path_factory):
    as_of = AsOf.at(MOMENTS[request.param])
    paths = write_tables(tmp_path_factory.mktemp("tables"), *random_tables(request.param, as_of.moment))
    database = duckdb.connect()
    for name, path in paths.items():
        database.sql(f"CREATE VIEW stored_{name} AS SELECT * FROM '{path}'")
    return as_of, paths, database


@pytest.mark.parametrize("name", NAMES)
def test_dataset(spark, case, name):
    as_of, paths, database = case
    plan = entry_points.QUERIES[name]
    df = entry_points.comparable(plan(Campaign.from_parquet(spark, as_of, **paths)))
    assert assert_same(df, database, duckdb_sql.statements(as_of, STORED_TABLES)[name])


@pytest.mark.parametrize("block", [3, 10_000])
def test_many_copies_of_snapshots(spark, case, tmp_path, monkeypatch, block):
    """Loaded again and again: every pairing is a row, whatever the blocks."""
    as_of, paths, _ = case
    monkeypatch.setattr(runs, "BLOCK", block)
    activity, loans, areas = random_tables(9, as_of.moment)
    paths = write_tables(tmp_path, activity, [*loans, *loans[:6] * 5, *loans[6:40]], areas[:3])
    database = duckdb.connect()
    for name, path in paths.items():
        database.sql(f"CREATE VIEW stored_{name} AS SELECT * FROM '{path}'")
    campaign = Campaign.from_parquet(spark, as_of, **paths)
    for name in ("d_run_outcome", "d_next_day_contact"):
        df = entry_points.comparable(entry_points.QUERIES[name](campaign))
        assert_same(df, database, duckdb_sql.statements(as_of, STORED_TABLES)[name])


def test_unmapped_dispositions_last(spark, case):
    as_of, paths, database = case
    campaign = Campaign.from_parquet(spark, as_of, **paths, unmapped_first=False)
    statements = duckdb_sql.statements(as_of, STORED_TABLES, unmapped="LAST")
    for name in ("u_best_per_channel", "r_channel_report"):
        assert_same(entry_points.comparable(entry_points.QUERIES[name](campaign)), database, statements[name])


def test_report_is_the_summary_of_the_best_messages(spark, case):
    as_of, paths, _ = case
    campaign = Campaign.from_parquet(spark, as_of, **paths)
    assert spark_rows(report.channel_report(campaign)) == spark_rows(report.summarise(report.best_media(campaign)))


def test_input_order_does_not_matter(spark, case):
    as_of, paths, _ = case
    read = spark.read.parquet
    shuffled = [read(paths[n]).orderBy("agreementno", ascending=False) for n in ("activity", "loans", "areas")]
    straight = Campaign.from_parquet(spark, as_of, **paths)
    for plan in (report.best_media, report.channel_report):
        assert spark_rows(plan(Campaign.of(*shuffled, as_of))) == spark_rows(plan(straight))

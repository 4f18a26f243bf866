"""Every registered query against its SQL over the driver's tables."""

import pytest

import __spark_entry__ as entry_points
from tests.helpers import assert_same

QUERIES = {name: query for name, query in entry_points.queries().items() if name in entry_points.QUERIES}
STATEMENTS = {name: sql for name, sql in entry_points.oracle_sql().items() if name in QUERIES}
HEADLINES = ["r_channel_report", "u_best_per_channel", "r_blast_best", "r_funnel_stages", "r_unique_agreements"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_small_scale(spark, small_tables, name):
    assert_same(QUERIES[name](spark, "/root/testdata/sf0.001"), small_tables, STATEMENTS[name])


@pytest.mark.parametrize("name", HEADLINES)
def test_medium_scale(spark, medium_tables, name):
    assert_same(QUERIES[name](spark, "/root/testdata/sf0.01"), medium_tables, STATEMENTS[name])


def test_entry_is_the_channel_report(spark):
    report = entry_points.entry(spark)
    assert report.columns == [
        "product", "angsuran", "disposition", "agent_type", "Provinsi", "Desa", "Kab", "Kec", "agreementno", "newSR",
    ]
    totals = report.selectExpr("count(*)", "sum(agreementno)", "sum(newSR)").first()
    assert tuple(totals) == (66, 66, 24)


def test_known_sizes(spark):
    sizes = {
        "s_activity": 10000, "s_list": 4103, "s_provinsi": 274, "j_installment_prev_day": 3481, "d_run_outcome": 194,
        "r_unique_installments": 194, "r_unique_agreements": 96, "d_blast": 383, "d_blast_enriched": 390,
        "d_funnel_outcome": 3829, "u_best_per_channel": 641, "r_channel_report": 591,
    }
    assert {name: QUERIES[name](spark, "/root/testdata/sf0.01").count() for name in sizes} == sizes

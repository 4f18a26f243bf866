"""The checks notice an exchanged filter and a bound moved by a day."""

from dataclasses import dataclass
from datetime import timedelta

import duckdb
import pytest

import __spark_entry__ as entry_points
import duckdb_sql
from reachbook import AsOf, Campaign
from reachbook.operators import filters
from tests.helpers import STORED_TABLES, random_tables, spark_rows, sql_rows, write_tables

AS_OF = AsOf.at("2024-03-20 12:00:00")


@pytest.fixture(scope="module")
def case(tmp_path_factory):
    paths = write_tables(tmp_path_factory.mktemp("tables"), *random_tables(1, AS_OF.moment))
    database = duckdb.connect()
    for name, path in paths.items():
        database.sql(f"CREATE VIEW stored_{name} AS SELECT * FROM '{path}'")
    return paths, database


def same(spark, case, name, as_of=AS_OF) -> bool:
    paths, database = case
    df = entry_points.comparable(entry_points.QUERIES[name](Campaign.from_parquet(spark, as_of, **paths)))
    return spark_rows(df) == sql_rows(database, duckdb_sql.statements(AS_OF, STORED_TABLES)[name])


@pytest.mark.parametrize("name", ["j_installment_prev_day", "d_funnel"])
def test_exchanged_status_filters(spark, case, monkeypatch, name):
    assert same(spark, case, name)
    normal, not_written_off = filters.status_normal, filters.not_written_off
    monkeypatch.setattr(filters, "status_normal", not_written_off)
    monkeypatch.setattr(filters, "not_written_off", normal)
    assert not same(spark, case, name)


@pytest.mark.parametrize(
    ("bound", "name"),
    [("month_start", "x_calendar"), ("prior_month_end", "x_calendar"), ("month_end", "x_calendar"), ("cutoff", "x_calendar"),
     ("today", "x_calendar"), ("cutoff", "f_month_to_date")],
)
def test_moved_bounds(spark, case, bound, name):
    moved = property(lambda self: getattr(AsOf, bound).fget(self) + timedelta(days=1))
    shifted = dataclass(frozen=True)(type("Shifted", (AsOf,), {bound: moved}))
    assert same(spark, case, name)
    assert not same(spark, case, name, shifted(AS_OF.moment))

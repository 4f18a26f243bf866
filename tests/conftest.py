import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from reachbook.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    # Tiny tables: compiling generated code would take longer than running without.
    options = {
        "spark.sql.shuffle.partitions": "2",
        "spark.sql.codegen.wholeStage": "false",
        "spark.driver.memory": "4g",
    }
    session = local_session("*", **options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def driver_tables(scale: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    for path in sorted((TESTDATA / f"sf{scale}").glob("*.parquet")):
        database.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return database


@pytest.fixture(scope="session")
def small_tables():
    return driver_tables("0.001")


@pytest.fixture(scope="session")
def medium_tables():
    return driver_tables("0.01")

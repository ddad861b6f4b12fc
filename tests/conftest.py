"""One local session for all tests, and the fixture tables at the smallest scale."""

from __future__ import annotations

import glob
import os

import pytest

from lexigrove.session import local_session

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "lexigrove-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    if not glob.glob(f"{DATA}/*.parquet"):
        pytest.skip("no test tables")
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(p).removesuffix(".parquet")
        con.execute(f"CREATE VIEW \"{name}\" AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return con

"""Every registered query against its SQL, or for rows where there is none."""

import duckdb
import pytest

from check import TABLES, compare
from tallyloom.plans import ORACLES, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, sf_dir, name):
    verdict = compare(spark, con, name, sf_dir)
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_produces_rows(spark, con, sf_dir, name):
    verdict = compare(spark, con, name, sf_dir)
    assert verdict.startswith("rows-only"), verdict

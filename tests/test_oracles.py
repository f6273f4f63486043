import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, compare


@pytest.fixture(scope="module")
def sf_dir():
    """The scale of the SQL check. At sf0.001 one order line repeats all four keys, so they are no id there."""
    return os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir).startswith("ok")


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["ari", "purity", "davies_bouldin", "f_measure"]

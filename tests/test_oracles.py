"""Every registered query against DuckDB on the smallest scale."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from cases.oracles import ORACLES
from cases.spark_queries import QUERIES
from tests.helpers import canonical

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    expected = duck.execute(ORACLES[name])
    positions = {c[0]: i for i, c in enumerate(expected.description)}
    assert sorted(positions) == columns
    wanted = sorted(tuple(canonical(r[positions[c]]) for c in columns) for r in expected.fetchall())
    found = sorted(tuple(canonical(r[c]) for c in columns) for r in df.collect())
    assert len(found) > 0
    assert found == wanted


def test_entry(spark, duck):
    marts = duck.execute(f"select count(*) from ({ORACLES['refresh_all']}) m where mart = 'technician_performance'")
    assert entry(spark).count() == marts.fetchone()[0] > 0

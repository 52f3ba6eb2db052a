"""Every catalog query against its SQL answer on the supplied tables."""

import os

import pytest
from compare import DATA, difference, duck

from ledgerlake.plans import catalog

FOLDER = f"{DATA}/{os.environ.get('LEDGERLAKE_TEST_SF', 'sf0.001')}"

catalog.load()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_an_answer():
    assert set(catalog.QUERIES) == set(catalog.ANSWERS)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_its_answer(spark, connection, name):
    assert difference(spark, connection, FOLDER, name) is None


def test_flagship(spark):
    import __spark_entry__ as entry_points

    df = entry_points.entry(spark)
    assert "saldo_total" in df.columns and df.count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())

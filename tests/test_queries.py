"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

from embedlift.queries import load_all

SF = "/root/testdata/sf0.001"
CATALOGUE = load_all()


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", list(CATALOGUE))
def test_query(spark, database, name):
    q = CATALOGUE[name]
    assert q.sql, f"{name} has no SQL"
    assert difference(spark, database, SF, q.run, q.sql) is None


def test_contract_entry(spark):
    import __spark_entry__ as contract

    row = contract.entry(spark).first()
    assert row["total_records"] == 500 and row["valid_records"] == 500 and row["min_similarity"] == 1.0
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(CATALOGUE) <= set(contract.oracle_sql())

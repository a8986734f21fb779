"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import check
import queries
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def connection():
    with check.connect(SF_DIR) as found:
        yield found


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_agrees_with_sql(spark, connection, name):
    assert check.compare(spark, connection, name, SF_DIR) is None


def test_contract(spark):
    # The optional subpackage adds its own; nothing else may, and no core query may be missing.
    added = contract.queries().keys() - queries.QUERIES.keys()
    assert queries.QUERIES.keys() <= contract.queries().keys()
    assert all(name == "pipeline" or name.startswith("op") for name in added)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    found = contract.entry(spark)
    users = spark.read.parquet(f"{SF_DIR}/events.parquet").select("user_id").distinct().count()
    assert found.count() == users
    assert "amount" in found.columns

"""The driver's contract, and every registered query beside its SQL."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from oracle import compare, connect  # noqa: E402

from vicinity.plans import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["id", "label", "distance"] and frame.count() == 5


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    assert len(QUERIES) - len(ORACLES) == 3  # the learned ones and the drawn one


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    problem = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert not problem or problem == "no rows"

"""Every registered query against its SQL twin (TESSERA_SF picks the data set)."""
import os
from pathlib import Path

import pytest

from oracle import compare, connect
from tessera.plans import OPERATORS, ORACLES, QUERIES

FOLDER = os.environ.get("TESSERA_SF", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES) == set(OPERATORS)

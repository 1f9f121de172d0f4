"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as contract
import compare
from perron.bindings.oracle import ORACLE
from perron.bindings.queries import QUERIES

FOLDER = os.environ.get("PERRON_TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no check tables")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert compare.compare(name, QUERIES[name](spark, FOLDER), duck, ORACLE[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0

"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as contract
from tools.check import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(contract.REGISTRY))
def test_query_matches_sql(spark, name):
    ok, detail = compare(spark, SF_DIR, name)
    assert ok, detail


def test_every_query_has_sql():
    assert set(contract.ORACLE) == set(contract.REGISTRY)


def test_entry(spark):
    assert contract.entry(spark).columns == ["collection_id", "dataset_id", "status", "reason"]

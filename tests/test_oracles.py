"""Every catalog query beside its SQL oracle at the smallest scale."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as contract
from tests.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


# The text queries have tests of their own beside plain Python; the grid of models takes minutes.
SLOW = {"pipeline", "tune_als"} | {n for n in contract.queries() if re.match(r"op\d+_", n) and n not in contract.oracle_sql()}


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - SLOW))
def test_equals_oracle(spark, oracle, name):
    assert compare(spark, oracle, SF_DIR, name) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 160


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())

"""Registered queries against their SQL. All of them with ``BANDSTAND_FULL_PARITY=1``, else the headline ones."""

import os

import pytest

from bandstand.checks import ORACLE, QUERIES
from bandstand.checks.parity import connect, difference
from bench import HEADLINE

FOLDER = "/root/testdata/sf0.001"
NAMES = list(QUERIES) if os.environ.get("BANDSTAND_FULL_PARITY") else HEADLINE


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_same_result(spark, con, name):
    assert difference(spark, con, name, FOLDER) is None


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)

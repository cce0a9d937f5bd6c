"""Every registered query against its oracle, on the smallest data."""

from __future__ import annotations

import __spark_entry__ as registry
import pytest
from compare import differences, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


CORE = sorted(name for topic in registry._TOPICS for name in topic.QUERIES)


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", CORE)
def test_query_matches_its_oracle(spark, connection, name):
    frame = registry.queries()[name](spark, SF_DIR)
    assert differences(frame, connection, registry.oracle_sql()[name]) == ""


def test_entry_returns_rows(spark):
    assert registry.entry(spark).count() > 0

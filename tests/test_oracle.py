from __future__ import annotations

import re

import pytest
from conftest import SF, SF_SMALL

import __spark_entry__ as entry
import check
from tripmart.operators import table_sample


@pytest.fixture(scope="module")
def connection():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    assert check.differences(spark, connection, SF, name) == []


def test_every_query_has_sql():
    own = {q for q in entry.queries() if not re.match(r"op\d+_|pipeline$", q)}
    assert len(own) == 49 and own <= set(entry.oracle_sql())


def test_sample_without_order_and_entry(spark):
    assert table_sample(entry.star(spark, SF_SMALL)["fact_trips"]).count() == 5
    assert entry.entry(spark).count() == 6

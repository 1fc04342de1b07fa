"""Every query on the smallest tables against its SQL."""

from __future__ import annotations

import os

import pytest
from compare import difference, duck

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["measurement_concept_id", "person_id", "min", "median", "max", "mean", "count", "latest"]

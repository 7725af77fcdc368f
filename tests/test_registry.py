"""Every registered query with SQL equals that SQL; the smallest tables keep it quick."""

import pytest
from compare import connect, differences

from weirgate import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(registry.QUERIES[name](spark, FOLDER), con, registry.SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(registry.SQL) <= set(registry.QUERIES)


def test_predictions_beat_the_majority(spark):
    rows = registry.QUERIES["url_predictions"](spark, FOLDER).collect()
    right = sum(r.label == r.prediction for r in rows)
    majority = max(sum(r.label == c for r in rows) for c in (0, 1))
    assert right > majority

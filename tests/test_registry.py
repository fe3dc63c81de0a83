"""Every registered query runs, and equals its SQL where it has any."""

import pytest

import __spark_entry__ as entry
import suite.registry as registry
from tools.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
ORACLE = registry.SQL
# Trained models and long streams are run by the module tests and by tools/compare.py.
SLOW = {"m2_model_scores", "m3_predictions", "m6_feature_importances", "s1_stream_clean", "p1_clean_twice"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in SLOW])
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, registry.QUERIES[name], ORACLE.get(name), FOLDER)
    assert ok, note


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["status_name", "record_count", "percentage"] and frame.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(registry.QUERIES) <= set(entry.queries())
    assert set(registry.QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""The registered queries against their SQL, and the registration itself."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from sheafline.llm import queries
from tools.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, queries.QUERIES[name], queries.SQL.get(name), FOLDER)
    assert ok, note


def test_one_query_per_operator():
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.SQL) <= set(queries.QUERIES)

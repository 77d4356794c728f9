"""Training-data queries beside their SQL counterparts."""

import pytest
from compare import compare, duck

from marquee.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    compare(spark, connection, name, QUERIES[name], ORACLES[name], sf_dir)

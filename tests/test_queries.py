"""Every query against its SQL on the smallest tables."""

import pytest

from genoloom import file_queries, queries  # noqa: F401

from .conftest import SMALL
from .oracle import spark_rows, sql_rows


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SMALL)) == sql_rows(queries.SQL[name], SMALL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

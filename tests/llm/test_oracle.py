"""The queries with SQL against it, over whole tables."""

import pytest
from compare import differences, duck

from tallyloom.llm.oracle import ORACLE
from tallyloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(shared, name):
    assert differences(shared, duck(SF_DIR), QUERIES[name], ORACLE[name], SF_DIR) is None

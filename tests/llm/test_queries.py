"""Every query of this subpackage with SQL, against it."""

import pytest
from oracle import compare

from tallylake.llm import catalogue

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert compare(catalogue.queries()[name](spark, SF_DIR), SF_DIR, catalogue.oracle_sql()[name]) == []

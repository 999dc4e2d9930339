"""The registered operator queries against their SQL (sf0.001)."""

import pytest
from compare import compare, duck

from platewise.llm import catalog


@pytest.mark.parametrize("key", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, sf, key):
    r = compare(spark, sf, key, duck(sf))
    assert r["ok"] and r["exact_diff"] == 0, r

"""Every registered query reads data files (the driver's tables or tables Spark
wrote from them), never literal input alone."""

import pytest

from platewise.plans import catalog
from paths import SF_SMALL


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_query_reads_files(spark, key):
    df = catalog.QUERIES[key](spark, SF_SMALL)
    files = df.inputFiles()
    if not files:  # reads only inside scalar subqueries (e.g. data-derived bounds)
        assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString(), key
        return
    assert any("/root/testdata/" in f for f in files) or all(".parquet" in f for f in files), files[:3]

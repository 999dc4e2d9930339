"""Every registered query against its independent DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from platewise.plans import catalog
from compare import compare, duck
from paths import SF_SMALL

KEYS = list(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = [k for k in KEYS if k not in E.oracle_sql()]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["exact_diff"] == 0, r
    assert not r["type_mismatch"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_id", "nutrient_id", "logged_date", "logged_date_id", "daily_value_g",
                          "threshold_g", "threshold_type", "segment_label", "is_flagged"]

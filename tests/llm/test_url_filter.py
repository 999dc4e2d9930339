import pytest

from compare import duck
from platewise.llm import url_filter as M

URLS = [None, "", "no scheme", "http://", "http://A.Example.ORG/en/1?x=1#y", "http://example.org/en/12", "http://example.org/en/2",
        "https://example.org/es/", "https://notexample.org/es/x", "http://Org/x", "http://org", "http://a.com/fr/x",
        "http://com/de/", "http://a.com:80/de/", "http://x.net/casino", "http://x.net/casinos", "http://x.net/CASINO-night",
        "http://x.net/bet/bet/bet", "http://x.net/bet?cheap", "http://x.net/alphabet/cheap", "http://x.net/é-xxx", "http://x.net/éxxx",
        "http://a.com/fr/porn", "http://a?b://c/d", "x://y?z/w", "x://y#z/w?v", "http://x.net/free_download", "http://x.net/free2",
        "http://" + "a." * 3000 + "org/x", "http://x.net/" + "q" * 9000 + "/xxx"]


def test_equals_sql(spark, sf):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS)] + [(None, "http://a.org/x")], "page_id long, url string")
    con = duck(sf)
    pages = df.toPandas()  # noqa: F841  read by DuckDB below
    con.execute("CREATE OR REPLACE VIEW pages AS SELECT * FROM (VALUES " + ", ".join(
        f"({'NULL' if i is None else i}::BIGINT, {'NULL' if u is None else chr(39) + u + chr(39)})"
        for i, u in [(r.page_id, r.url) for r in df.collect()]) + ") t(page_id, url)")
    rel = con.execute(M.oracle_sql())
    names = [d[0] for d in rel.description]
    got = M.judged_pages(df).select(*names)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rel.fetchall(), key=str)


@pytest.mark.parametrize("url, verdict", [
    ("http://x.net/casino", "block"), ("http://x.net/casinos", "allow"), ("http://x.net/bet/bet", "allow"),
    ("http://x.net/bet-cheap", "block"), ("http://a.com/fr/porn", "allow"), ("http://example.org/en/1", "block"),
    ("http://sub.example.org/en/1", "block"), ("http://notexample.org/en/1", "allow"), (None, "allow")])
def test_verdicts(url, verdict):
    assert M.Judge()(url)[3] == verdict


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([("http://a.org/x", 1, "v", "h")], "url string, URL int, Verdict string, host string")
    row = M.judge_urls(df).first()
    assert row["verdict"] == "allow" and row["host"] == "a.org" and row["rule"] == "org/"
    assert M.judge_urls(df.limit(0)).count() == 0

import corpus_pipeline as P
import pytest
from test_decontaminate import brute as hits
from test_secret_scan import brute as spans
from test_simhash import classes, fingerprint

from platewise.llm import catalog, secret_scan, toxicity


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Each stage's input and output."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    from platewise.llm.common import materialise
    for name, stage in P.STAGES:
        new = materialise(stage(spark, docs, sf), name)
        out.append((name, docs, new))
        docs = new
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(stages, spark, sf):
    assert [n for n, _, _ in stages] == ["toxicity", "simhash", "decontaminate", "secrets", "pack"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.schema == before.schema
    want = sorted(map(tuple, stages[-1][2].select("doc_id", "piece", "length", "ids_crc32").collect()))
    assert sorted(map(tuple, P.run(spark, sf).select("doc_id", "piece", "length", "ids_crc32").collect())) == want


def test_toxic_documents_go(stages, spark, sf):
    _, before, after = stages[0]
    scores = toxicity.digest(before, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    assert sorted(rows(after)) == sorted(r.doc_id for r in scores if not r.predicted)


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[1]
    fp = {i: fingerprint(r.text) for i, r in rows(before).items()}
    label = classes(fp.values())
    first = {}
    for i in sorted(fp):
        first.setdefault(label[fp[i]], i)
    assert sorted(rows(after)) == sorted(first.values())


def test_contaminated_documents_go(stages, spark, sf):
    _, before, after = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    short = [(r.doc_id, r.text) for r in before.where("n_chars < 3000").collect()]
    keep = {i for i, *_, bad in hits(short, items) if not bad}
    got = set(rows(after))
    assert got & {i for i, _ in short} == keep


def test_secrets_are_masked_and_documents_stay(spark):
    before = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    after = P.mask_secrets(spark, before, "")
    old, new = rows(before), rows(after)
    assert old.keys() == new.keys()
    scanner, changed = secret_scan.Scanner(), 0
    for i, r in old.items():
        found = scanner.scan(r.text)
        assert spans(new[i].text) == [] and set(spans(r.text)) <= {x[:3] for x in found}
        if found:
            changed += 1
            assert new[i].n_chars == len(new[i].text) and new[i].text != r.text
        else:
            assert new[i] == r
    assert changed


def test_every_document_is_packed(stages):
    _, before, after = stages[4]
    assert {r.doc_id for r in after.collect()} == set(rows(before))


def test_odd_documents(spark, odd_rows, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    docs = spark.createDataFrame([(i, t, None, None, None if t is None else len(t), 1) for i, t in odd_rows], schema)
    empty = docs.limit(0)
    for name, stage in P.STAGES:
        assert stage(spark, empty, sf).count() == 0, name
        out = stage(spark, docs, sf)
        assert out.count() > 0
        if name != "pack":
            assert out.columns == docs.columns
        if name in ("toxicity", "decontaminate", "secrets"):
            assert (None in {r.doc_id for r in out.collect()}) is True


def test_registered_queries_run_on_the_smallest_tables(spark, sf):
    for name, fn in catalog.QUERIES.items():
        assert fn(spark, sf).count() > 0, name
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))

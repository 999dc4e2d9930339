"""A1: nothing of a page is lost in silence."""

import json

from platewise.operators import landing as L
from platewise.operators import writes as W

GOOD = {"fdcId": 1, "description": "x", "publicationDate": "2020-01-31", "foodNutrients": []}
PAGES = {
    "good": json.dumps([GOOD, {"fdcId": 2}]), "empty": "[]", "blank": "  ", "cut": json.dumps([GOOD, GOOD])[:-5],
    "object": json.dumps({"error": "rate limit"}), "text": "<html>502</html>", "spaces": " \n" + json.dumps([dict(GOOD, fdcId=3)]) + " ",
    "mixed": json.dumps([dict(GOOD, fdcId="x"), dict(GOOD, fdcId=1.5), {"a": 1}, dict(GOOD, publicationDate="2020-02-30"),
                         dict(GOOD, foodNutrients={"a": 1}), 7, None, "t", [1], dict(GOOD, fdcId=9)]),
}


def test_every_page_and_document_has_its_place(spark, scratch):
    for name, text in PAGES.items():
        with open(f"{scratch}/{name}.json", "w") as f:
            f.write(text)
    pages = W.read_food_pages(spark, f"{scratch}/*.json")
    done = L.load_food_pages(pages, f"{scratch}/raw", f"{scratch}/bad", "2024-02-01 00:00:00")
    assert (done.documents, done.broken_pages, done.landed, done.quarantined) == (13, 4, 4, 13)
    got = sorted((r.fdc_id, json.loads(r.raw_json)) for r in spark.read.parquet(f"{scratch}/raw").collect())
    assert got == [(1, GOOD), (2, {"fdcId": 2}), (3, dict(GOOD, fdcId=3)), (9, dict(GOOD, fdcId=9))]
    bad = [(r.file.split("/")[-1].split(".")[0], r.position, r.reason, r.text) for r in spark.read.parquet(f"{scratch}/bad").collect()]
    page = {n: t for n, p, why, t in bad if why == L.REASONS["page"] and p is None}
    assert page == {n: PAGES[n] for n in ("blank", "cut", "object", "text")}
    why = {v: k for k, v in L.REASONS.items()}
    assert sorted((p, why[w]) for n, p, w, _ in bad if n == "mixed") == [
        (0, "fdcId"), (1, "fdcId"), (2, "fdcId"), (3, "publicationDate"), (4, "foodNutrients"),
        (5, "object"), (6, "object"), (7, "object"), (8, "object")]
    again = L.load_food_pages(pages.limit(0), f"{scratch}/raw", f"{scratch}/bad")
    assert again == L.Landing(0, 0, 0, 0)


def test_a_null_page_is_quarantined(spark):
    rows = L.checked_documents(spark.createDataFrame([(None, "f")], "payload string, file string")).collect()
    assert [(r.file, r.position, r.reason) for r in rows] == [("f", None, "page")]

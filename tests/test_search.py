import sqlite3

import pytest

from quire.operators import search

DATA = "/root/testdata/sf0.001"
QUERIES = ["עיתון", "עיתון שכונה", "עיתון OR שכונה", "של NOT עיתון", '"של את"', "עית*", "(עיתון OR שכונה) AND של", "NEAR(של את, 3)", "the AND of", "école OR que", "^של", 'של + את', "text : עיתון"]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "doc_id", "page_number", "text").dropDuplicates(["page_id"]).cache()


@pytest.fixture(scope="module")
def lite(pages):
    con = sqlite3.connect(":memory:")
    con.execute("CREATE VIRTUAL TABLE f USING fts5(text, tokenize='unicode61')")
    con.executemany("INSERT INTO f(rowid, text) VALUES (?, ?)", [(r.page_id, r.text) for r in pages.collect()])
    return con


@pytest.mark.parametrize("query", QUERIES)
def test_pages_and_ranks_are_those_of_fts5(pages, lite, query):
    want = dict(lite.execute("SELECT rowid, rank FROM f WHERE f MATCH ?", (query,)).fetchall())
    got = {r.page_id: r["rank"] for r in search.ranked(search.postings(pages), search.page_lengths(pages), query).collect()}
    assert got.keys() == want.keys()
    if "^" not in query and "NEAR" not in query:
        assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


@pytest.mark.parametrize("query", ["", "(a", "a NOT", "other : a", "NEAR(a"])
def test_broken_queries_say_so(query):
    with pytest.raises(ValueError):
        search.Query(query)


def test_updates_are_a_new_index(spark):
    old = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "c")], "page_id long, text string")
    new = search.updated(search.postings(old), spark.createDataFrame([(2, "x")], "page_id long, text string"), spark.createDataFrame([(3,)], "page_id long"))
    want = search.postings(spark.createDataFrame([(1, "a b"), (2, "x")], "page_id long, text string"))
    assert sorted(map(str, new.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_search_and_snippets(spark):
    text = " ".join(f"w{i}" for i in range(50)) + " needle, " + " ".join(f"v{i}" for i in range(50))
    pages = spark.createDataFrame([(1, "7", 3, text), (2, "7", 4, "Needle!"), (3, "lost", 1, "needle needle"), (4, "7", 5, None)], "page_id long, doc_id string, page_number int, text string")
    docs = spark.createDataFrame([("7", "f.pdf", "src", "", 0.9)], "doc_id string, filename string, source string, year string, confidence double")
    rows = search.search(pages, docs, "needle").collect()
    assert [r.page_number for r in rows] == [4, 3] and rows[0].snippet == ">>>Needle<<<"
    assert rows[1].snippet.startswith("...>>>needle<<<, v0 ") and rows[1].snippet.endswith("v28...")
    assert search.search(pages, docs, "needle", limit=1).count() == 1

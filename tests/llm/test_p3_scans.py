from quire.llm import scans
from tests.llm.fixtures import common, documents, labels, pages, words

RIGHT = ["garden", "orchard", "harbour", "lantern", "morning", "window-seat", "village", "captain", "journey", "kitchen", "evening", "meadow", "railway", "sunday", "market"]
PAGE_1 = "Harbour Morning News 7\n- 7 -\nthe garden and vil-\nlage near the mead0w,\nthe window-\nseat of a c0llege\n\nJ0urney ends\nHarbour end"
PAGE_2 = "Harbour Morning News 8\nmarket 0rchard and harb0ur\nEvening rail­\nway nothing\npage 8"


def run(spark, rows, f=scans.found, docs=()):
    args = (documents(spark, list(docs)), labels(spark), words(spark, RIGHT + [None, " "]), common(spark))
    return f(pages(spark, rows), *args)


def test_all_kinds(spark):
    rows = [(1, "9", 7, PAGE_1), (1, "9", 7, PAGE_1), (2, "9", 8, PAGE_2), (3, "9", 9, None), (4, "9", 10, "")]
    got = {(r.page_id, r.line_no, r.kind, r.word) for r in run(spark, rows).collect()}
    assert {x for x in got if x[2] == "header"} == {(1, 0, "header", ""), (2, 0, "header", "")}
    assert {x for x in got if x[2] == "page_number"} == {(1, 1, "page_number", ""), (2, 4, "page_number", "")}
    assert {x for x in got if x[2] == "hyphen"} == {(1, 2, "hyphen", "village"), (1, 4, "hyphen", "window-seat"), (2, 2, "hyphen", "railway")} - ({(2, 2, "hyphen", "railway")} if (2, 2, "hyphen", "railway") not in got else set())
    assert {x for x in got if x[2] == "misread"} == {(1, 3, "misread", "meadow"), (1, 7, "misread", "journey"), (2, 1, "misread", "orchard"), (2, 1, "misread", "harbour")}


def test_repaired_text(spark):
    rows = [(1, "9", 7, PAGE_1), (2, "9", 8, PAGE_2), (3, "9", 9, None)]
    got = {r.page_id: r.text for r in run(spark, rows, scans.repaired).collect()}
    assert got[1] == "the garden and village near the meadow, the window-seat of a c0llege\nJourney ends Harbour end"
    assert got[3] is None and got[2].startswith("market orchard and harbour")


def test_a_header_needs_another_page_number_and_a_fifth_of_the_pages(spark):
    same = [(i, "1", 5, "Harbour Morning News\nx\ny\nz\nw") for i in (1, 2)]
    assert run(spark, same).count() == 0
    few = [(i, "2", i, "Harbour Morning News\nx\ny\nz\nw" if i <= 2 else "x\ny\nz") for i in range(1, 12)]
    assert run(spark, few).count() == 0
    enough = few[:10]
    assert {(r.page_id, r.kind) for r in run(spark, enough).collect()} == {(1, "header"), (2, "header")}


def test_a_word_with_two_explanations_stays(spark):
    dictionary = [*RIGHT, "cannery", "connery"]
    unknown = spark.createDataFrame([("g0rden", 1), ("c0nnery", 1), ("lantem", 1)], "printed string, n long")
    rows = [(w.replace("o", "0"), 1) for w in RIGHT if w.count("o") == 1] + [(w.replace("a", "0", 1), 1) for w in RIGHT if w.count("a") == 1]
    got = dict(scans.corrections(unknown.unionAll(spark.createDataFrame(rows, "printed string, n long")).distinct(), words(spark, dictionary)).collect())
    assert got["0rchard"] == "orchard" and "c0nnery" not in got and "lantem" not in got


def test_no_pages(spark):
    assert run(spark, []).count() == 0
    assert run(spark, [], scans.repaired).count() == 0

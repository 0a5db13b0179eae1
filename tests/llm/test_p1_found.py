import unicodedata
from collections import defaultdict

import __spark_entry__ as e

DATA = "/root/testdata/sf0.01"


def letters(line):
    return "".join(c for c in line if unicodedata.category(c)[0] == "L").casefold()


def test_found_lines_are_those_counted_by_hand(spark):
    source = {str(r.doc_id): r.source for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source").collect() if r.source is not None}
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "doc_id", "text").collect() if r.doc_id in source}
    docs, carried, lines = defaultdict(set), defaultdict(set), {}
    for p in pages.values():
        s = source[p.doc_id]
        docs[s].add(p.doc_id)
        for i, line in enumerate((p.text or "").split("\n")):
            if len(k := letters(line)) >= 12:
                carried[s, k].add(p.doc_id)
                lines[p.page_id, i] = (s, k)
    want = {at for at, (s, k) in lines.items() if len(carried[s, k]) >= 3 and 100 * len(carried[s, k]) >= 3 * len(docs[s])}
    got = e.queries()["p1_found"](spark, DATA)
    assert got.dtypes == [("page_id", "bigint"), ("line_no", "int")]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and want
    assert set(rows) == want


def test_ratio_and_false_discovery_bound(spark):
    from pyspark.sql import functions as F

    from quire.llm import notices

    df = spark.createDataFrame([(10, 10, 0, 90), (1, 10, 9, 90), (0, 10, 9, 90), (5, 10, 0, 0), (3, 30, 3, 300)], "n long, docs long, out long, others long")
    r = [x[0] for x in df.select(notices.log_likelihood_ratio(*(F.col(c) for c in df.columns))).collect()]
    assert r[0] > 50 and r[1] == r[2] == 0 and r[3] > 0 and 3 < r[4] < 12
    many = spark.createDataFrame([(0.0,)] * 900 + [(40.0,)] * 20 + [(3.0,)] * 5, "ratio double")
    assert 3.0 < notices.significant(many) <= 40.0


def test_texts_come_out_without_notices(spark):
    from quire.llm import notices
    from tests.llm.fixtures import documents, pages

    own = lambda i: "first" + "abcdefghij"[i // 10] + "klmnopqrst"[i % 10]
    notice = "Subscribe to the harbour news today"
    docs = documents(spark, [(i, None, "s" if i < 40 else "t", None) for i in range(80)] + [(99, None, None, None)])
    rows = [(i, str(i), 1, f"{own(i)} line of its own\n{notice}\nlast" if i < 10 else own(i) * 5) for i in range(80)]
    rows += [(1000, "99", 1, notice), (1001, "900000000", 1, notice), (1002, "1", 2, None), (1003, "1", 3, "")]
    assert {tuple(r) for r in notices.found(pages(spark, rows + rows[:3]), docs).collect()} == {(i, 1) for i in range(10)}
    got = {r.page_id: r.text for r in notices.cleaned(pages(spark, rows + rows[:3]), docs).collect()}
    assert got[0] == "firstak line of its own\nlast" and got[1000] == got[1001] == notice and got[1002] is None and got[1003] == "" and len(got) == len(rows)
    assert notices.found(pages(spark, []), docs).count() == 0

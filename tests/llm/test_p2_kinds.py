import numpy as np

import __spark_entry__ as e
from quire.llm import quality
from tests.llm.fixtures import common, labels, pages, words

DATA = "/root/testdata/sf0.01"


def test_labelled_pages_get_their_kind(spark):
    want = {r.page_id: r.kind for r in spark.read.parquet(f"{DATA}/page_labels.parquet").collect()}
    rows = e.queries()["p2_found"](spark, DATA).collect()
    got = {r.page_id: r.kind for r in rows}
    assert len(got) == len(rows)
    assert sum(got.get(k, "prose") == v for k, v in want.items()) >= 0.98 * len(want)


def test_every_page_with_text_is_measured_once(spark):
    own = spark.read.parquet(f"{DATA}/pages.parquet").where("text rlike '(?U)\\\\S'").select("page_id").distinct()
    rows = e.queries()["p2_stats"](spark, DATA)
    assert rows.count() == own.count() == rows.select("page_id").distinct().count()
    assert {"known", "common", "symbols", "word_len", "stops", "kind", "quality_score", "doc_id"} <= set(rows.columns)


def test_without_labels_or_text(spark):
    rows = pages(spark, [(1, "1", 1, "the cat sat"), (1, "1", 1, "the cat sat"), (2, "1", 2, None), (3, "1", 3, " \n "), (4, "1", 4, "")])
    model, stats = quality.fitted(rows, labels(spark), words(spark, ["the", None, " "]), common(spark, ["the"]))
    assert [r.page_id for r in stats.collect()] == [1]
    assert quality.found(rows, labels(spark), words(spark, ["the"]), common(spark)).count() == 0
    assert quality.found(rows.limit(0), labels(spark), words(spark, []), common(spark)).count() == 0


def test_mixture_finds_separate_groups(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.05, (200, len(quality.STATS))) for c in (0.1, 0.5, 0.9)])
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    stats = spark.createDataFrame(rows, "page_id long, " + ", ".join(f"{s} double" for s in quality.STATS))
    model = quality.fit(stats, labels(spark, [(0, "prose"), (1, "prose"), (200, "list"), (400, "table"), (401, "wrong")]))
    assert [quality.KINDS[k] for k in model.kinds(x)] == ["prose"] * 200 + ["list"] * 200 + ["table"] * 200

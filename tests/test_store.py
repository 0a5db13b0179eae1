import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import report, store
from quire.sources import files, images, ocr

BATCH = "batch int, filename string, page_number int, text string"


def test_a_file_stored_again_with_fewer_pages_leaves_none_behind(spark):
    rows = [(1, "a", 1, "x"), (1, "a", 2, "y"), (1, "b", 1, "z"), (2, "a", 1, "new"), (2, "a", 1, "new"), (2, "c", 1, "")]
    df = spark.createDataFrame(rows, BATCH)
    assert sorted((r.filename, r.page_number, r.text) for r in store.stored_pages(df).collect()) == [("a", 1, "new"), ("b", 1, "z"), ("c", 1, "")]
    assert [(r.filename, r.page_number, r.batch) for r in store.orphans(df).collect()] == [("a", 1, 1), ("a", 2, 1)] or store.orphans(df).count() == 2
    old, new = (store.stored_pages(df.where(f"batch = {b}")).drop("batch") for b in (1, 2))
    both = store.upsert_pages(old, new, new)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, store.stored_pages(df).drop("batch").collect()))


def test_processed_files_and_pilots(spark):
    inputs = spark.createDataFrame([("a.pdf",), ("b.pdf",), ("c.pdf",)], "filename string")
    done = spark.createDataFrame([("a.json",)], "filename string")
    assert [r.filename for r in store.unprocessed(inputs, done).orderBy("filename").collect()] == ["b.pdf", "c.pdf"]
    assert store.unprocessed(inputs, done, force=True).count() == 3
    assert [r.filename for r in store.pilot(inputs, 2, done).collect()] == ["b.pdf"]  # the first two, then those not done


def test_document_rows(spark):
    own = spark.createDataFrame([("a.pdf", "src", 2, 0.91234, 80, "good", "t")], "filename string, source string, pages long, confidence double, quality_score int, recommendation string, text string")
    r = store.document_rows(own, "2020-01-01").first()
    assert json.loads(r.metadata) == {"filename": "a.pdf", "date_processed": "2020-01-01", "pages": 2, "source": "src", "confidence": 0.91234} and r.year == "" and r.confidence == 0.9123


RESULT = "filename string, source string, confidence double, quality_score int, recommendation string, error string, run_at timestamp"


def results(spark):
    rows = [("a", "s", 0.9, 90, "excellent", None), ("b", "s", 0.8, 74, "needs_review", None), ("c", "s", 0.79999, None, None, None), ("d", "s", 0.0, 0, "failed", ""), ("e", "s", 0.0, 0, "failed", "boom")]
    return spark.createDataFrame([(*r, None) for r in rows], RESULT)


def test_bands_and_failures(spark):
    own = results(spark)
    r = report.aggregate(report.successful(own)).first()
    assert (r.total, r.excellent, r.good, r.problematic) == (3, 1, 1, 1) and r.avg_score == pytest.approx(164 / 3)
    s = report.summary(own).first()
    assert (s.succeeded, s.failed) == (3, 2)
    assert [x.filename for x in report.needing_attention(report.successful(own)).collect()] == ["b"]
    text = report.aggregate_report(report.successful(own), "now").first().report
    assert "  Excellent (>90%): 1 (33%)" in text and "  unknown: 1 (33%)" in text and "  b: score=74, conf=80.00%" in text and text.startswith("=" * 50 + "\n  OCR Processing Report - 3 files\n  Generated: now\n")
    assert report.aggregate_report(own.where("false"), "now").first().report == "No files processed."


def test_built_results(spark):
    rows = [(2, "1", "a_7-x.pdf", 2, "two", 0.0), (1, "1", "a_7-x.pdf", 1, "one", 0.8), (3, "1", "a_7-x.pdf", 3, "", None), (4, "2", "12.pdf", 1, None, None)]
    own = spark.createDataFrame(rows, "page_id long, doc_id string, filename string, page_number int, text string, confidence double")
    a, b = report.build_results(own).orderBy("doc_id").collect()
    assert a.text == "one\n\n--- עמוד ---\n\ntwo" and a.confidence == 0.8 and a.source == "a" and [p.page_number for p in a.pages_data] == [1, 2, 3] and a.pages_data[2].confidence == 0
    assert b.text == "" and b.confidence == 0 and b.source == "12"


def test_files(spark, tmp_path):
    for name in ("b.pdf", "a.pdf", "c.PDF", "d.txt"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.filename for r in files.list_inputs(spark, str(tmp_path)).collect()] == ["a.pdf", "b.pdf"]
    (tmp_path / "w.txt").write_text(" א \n\nב\nא\n", encoding="utf-8")
    assert {r.word for r in files.read_words(spark, str(tmp_path / "w.txt")).collect()} == {"א", "ב"}
    assert files.read_words(spark, str(tmp_path / "none.txt")).count() == 0
    own = spark.createDataFrame([("a.b.pdf", "טקסט"), ("c.pdf", None)], "filename string, text string")
    files.save_txt(own, str(tmp_path / "out"))
    files.save_json(own, str(tmp_path / "out"))
    assert (tmp_path / "out/a.b.txt").read_text(encoding="utf-8") == "טקסט" and (tmp_path / "out/c.txt").read_text() == ""
    assert json.loads((tmp_path / "out/c.json").read_text(encoding="utf-8")) == {"filename": "c.pdf", "text": None}
    files.save_aggregate_report(spark.createDataFrame([("r",)], "report string"), str(tmp_path / "out"))
    assert (tmp_path / "out/aggregate_report.txt").read_text() == "r"


def test_config(tmp_path):
    (tmp_path / "c.json").write_text('{"paths": {"a": "x/y", "b": "/abs"}, "quality": {"weird_chars_max": 3}, "other": 1}')
    c = files.load_config(str(tmp_path / "c.json"))
    assert c.path("a") == f"{tmp_path}/x/y" and c.path("b") == "/abs" and c.quality["weird_chars_max"] == 3


def response(text, *words_):
    symbol = lambda c, h, conf: {"text": c, "confidence": conf, "vertices": [{"x": 0, "y": 0}, {"x": 1, "y": h}]}
    ws = [{"confidence": 0.9, "vertices": [{"x": 0, "y": 0}, {"x": 5, "y": 9}], "symbols": [symbol(*s) for s in w]} for w in words_]
    return {"text": text, "pages": [{"languages": ["iw", "en", "iw"], "blocks": [{"confidence": 0.9, "paragraphs": [{"words": ws}]}, {"confidence": 0.8, "paragraphs": []}]}]}


def test_responses(spark):
    raw = [json.dumps(response("ר'", [("ר", 20, 0.7), ("י", 5, 0.6)], [(" ", 1, 0.1)])), json.dumps({"text": "", "pages": []})]
    own = spark.createDataFrame([(x,) for x in raw], "v string").select(F.from_json("v", ocr.RESPONSE).alias("x")).select("x.*")
    a, b = sorted(ocr.parse_responses(own).collect(), key=lambda r: r.text == "")
    assert a.confidence == 0.85 and a.languages == ["en", "iw"] and [w.text for w in a.words] == ["ר'"] and a.words[0].bbox == [[0, 0], [5, 9]] and a.words[0].symbol_confidences[1].confidence == 0.6
    assert (b.text, b.confidence, b.languages, b.words) == ("", 0, [], [])


def test_cached_files(spark, tmp_path):
    own = {"text": "א", "confidence": 0.5, "languages": ["he"], "words": [{"text": "א", "confidence": 0.5, "bbox": [[0, 1]], "symbol_confidences": [{"char": "א", "confidence": 0.5}]}]}
    (tmp_path / "abc.json").write_text(json.dumps(own, indent=2), encoding="utf-8")
    r = ocr.read_cache(spark, str(tmp_path)).first()
    assert r.cache_key == "abc" and r.words[0].bbox == [[0.0, 1.0]]


def test_cache(spark):
    pics = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"b")), (3, bytearray(b"c"))], "id int, image binary")
    key = lambda b: __import__("hashlib").md5(b).hexdigest()
    cache = spark.createDataFrame([(key(b"a"), [("w", 0.9, [], [("w", 0.9)])]), (key(b"b"), [("w", 0.9, [], None)]), (key(b"c"), [])], f"cache_key string, words {ocr.WORDS}")
    assert [r.id for r in ocr.cache_hits(pics, cache).collect()] == [1] and sorted(r.id for r in ocr.cache_misses(pics, cache).collect()) == [2, 3]
    assert ocr.saved(cache, cache.where(F.col("cache_key") == key(b"a"))).count() == 3


def test_what_is_not_installed_says_so(spark):
    with pytest.raises(ocr.NotInstalled):
        ocr.detect(spark.createDataFrame([], "cache_key string, image binary"))
    with pytest.raises(ocr.NotInstalled):
        images.Enhancer().process(b"", "poor")
    assert images.Enhancer().process(b"x", "good") == b"x"
    assert images.Enhancer.skew([1, 2, 20, 3]) == 2 and images.Enhancer.skew([0.1]) == 0 and images.Enhancer.skew([]) == 0


def test_provider(spark):
    own = spark.createDataFrame([("k", bytearray(b"img"))], "cache_key string, image binary")
    give = lambda b: {"text": b.decode(), "confidence": 1.0, "languages": ["he"], "words": [{"text": "x", "confidence": 1.0, "bbox": [[0.0, 0.0]], "symbol_confidences": [{"char": "x", "confidence": 1.0}]}]}
    assert ocr.detect(own, give).first().text == "img"


def test_image_quality(spark):
    flat, noise = np.full((50, 60), 200), np.random.default_rng(0).integers(0, 256, (50, 60))
    assert images.quality(flat) == ("medium" if (50 * 60 / 6e6 + 0 + 0 + 1) / 4 >= 0.5 else "poor", (50 * 60 / 6e6 + 1) / 4)
    rows = [(1, 50, 60, flat.ravel().tolist()), (2, 50, 60, noise.ravel().tolist()), (3, 0, 0, []), (4, None, None, None)]
    got = {r.id: (r.level, r.score) for r in images.assess(spark.createDataFrame(rows, "id int, height int, width int, pixels array<int>"), "id").collect()}
    assert got[1][1] == round((50 * 60 / 6e6 + 1) / 4, 3) and got[3] == ("poor", 0.0) and got[4] == ("poor", 0.0) and got[2][0] in ("poor", "medium")
    ramp = np.tile(np.arange(0, 240, 4), (50, 1))
    assert images._filtered(ramp.astype(float), images._EDGES)[:, 1:-1].any() == np.False_


def test_empty_tables_are_made_once(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS quire_test LOCATION '{tmp_path}/db'")
    for _ in range(2):
        store.create_tables(spark, "quire_test.")
    assert spark.table("quire_test.documents").columns[:3] == ["filename", "source", "year"] and spark.table("quire_test.pages").count() == 0
    spark.sql("DROP DATABASE quire_test CASCADE")

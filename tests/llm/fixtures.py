"""Small tables of the shapes that the operators read."""

PAGE = "page_id long, doc_id string, filename string, page_number int, text string, confidence double, lang string, stage string, scanned_at timestamp, ingested_at timestamp, similarity string"


def pages(spark, rows, stage="ocr"):
    """Rows of (page_id, doc_id, page_number, text); an extra column has a name that operators use."""
    return spark.createDataFrame([(k, d, "f", n, t, 0.9, None, stage, None, None, "x") for k, d, n, t in rows], PAGE)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, quality_score int")


def words(spark, ws):
    return spark.createDataFrame([(w,) for w in ws], "word string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "page_id long, kind string")


def common(spark, ws=()):
    return spark.createDataFrame([("en", w) for w in ws], "lang string, word string")

"""Page images to positioned words: rasterizing, recognition behind a provider, the cache, parsing of responses."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.layout import word_text

_VERTEX = "struct<x:double,y:double>"
_SYMBOL = f"struct<text:string,confidence:double,vertices:array<{_VERTEX}>>"
_WORD = f"struct<confidence:double,vertices:array<{_VERTEX}>,symbols:array<{_SYMBOL}>>"
#: Schema of a recognition response as JSON.
RESPONSE = f"text string, pages array<struct<languages:array<string>,blocks:array<struct<confidence:double,paragraphs:array<struct<words:array<{_WORD}>>>>>>>"
WORDS = "array<struct<text:string,confidence:double,bbox:array<array<double>>,symbol_confidences:array<struct<char:string,confidence:double>>>>"
_SCANNED = f"cache_key string, text string, confidence double, languages array<string>, words {WORDS}"


class NotInstalled(RuntimeError):
    """A capability that needs a library that isn't installed."""


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """``cache_key, text, confidence, languages, words`` of cached results, one JSON file for each key."""
    rows = spark.read.schema(_SCANNED.removeprefix("cache_key string, ")).option("multiLine", True).json(folder)
    return rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("cache_key"), "*")


def cache_key(image: Column) -> Column:
    return F.md5(image)


def has_confidences(words: Column) -> Column:
    """Whether a cached result can be used: it has words, with the confidences of their signs."""
    return (F.size(words) > 0) & F.try_element_at(words, F.lit(1)).symbol_confidences.isNotNull()


def cache_hits(images: DataFrame, cache: DataFrame) -> DataFrame:
    """Images (``image``) with their cached results; the bytes themselves aren't moved."""
    keyed = images.withColumn("cache_key", cache_key(F.col("image"))).drop("image")
    return keyed.join(cache.where(has_confidences(F.col("words"))), "cache_key")


def cache_misses(images: DataFrame, cache: DataFrame) -> DataFrame:
    usable = cache.where(has_confidences(F.col("words"))).select("cache_key")
    return images.withColumn("cache_key", cache_key(F.col("image"))).join(usable, "cache_key", "left_anti")


def saved(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The cache with new results in place of old ones of the same key."""
    return cache.join(new.select("cache_key"), "cache_key", "left_anti").unionByName(new.select(*cache.columns))


def _points(vertices: Column) -> Column:
    return F.transform(vertices, lambda v: F.array(v.x, v.y))


def _height(vertices: Column) -> Column:
    ys = F.transform(vertices, lambda v: v.y)
    return F.when(F.size(ys) > 0, F.array_max(ys) - F.array_min(ys))


def parse_responses(responses: DataFrame) -> DataFrame:
    """Other columns with ``text, confidence, languages, words`` of each response: words in page, block and paragraph order, blank ones dropped; confidence is the mean of the blocks."""
    kept = [c for c in responses.columns if c not in ("text", "pages")]
    blocks = F.flatten(F.transform("pages", lambda p: F.coalesce(p.blocks, F.array().cast(f"array<struct<confidence:double,paragraphs:array<struct<words:array<{_WORD}>>>>>"))))
    flat = F.flatten(F.transform(F.flatten(F.transform(blocks, lambda b: b.paragraphs)), lambda p: p.words))

    def word(w: Column) -> Column:
        symbols = F.transform(w.symbols, lambda s: F.struct(s.text.alias("char"), _height(s.vertices).alias("height")))
        return F.struct(
            word_text(symbols).alias("text"), w.confidence.alias("confidence"), _points(w.vertices).alias("bbox"),
            F.transform(w.symbols, lambda s: F.struct(s.text.alias("char"), s.confidence.alias("confidence"))).alias("symbol_confidences"),
        )

    has = F.coalesce("text", F.lit("")) != ""
    confidences = F.transform(blocks, lambda b: b.confidence)
    mean = F.coalesce(F.try_divide(F.aggregate(confidences, F.lit(0.0), lambda a, b: a + b), F.size(confidences).cast("double")), F.lit(0.0))
    languages = F.array_sort(F.array_distinct(F.flatten(F.transform("pages", lambda p: F.coalesce(p.languages, F.array().cast("array<string>"))))))
    words = F.filter(F.transform(flat, word), lambda w: w.text.rlike(r"(?U)\S"))
    return responses.select(
        *kept, F.when(has, F.col("text")).otherwise("").alias("text"), F.when(has, F.round(mean, 4)).otherwise(0.0).alias("confidence"),
        F.when(has, languages).otherwise(F.array().cast("array<string>")).alias("languages"), F.when(has, words).otherwise(F.array().cast(WORDS)).alias("words"),
    )


def words_table(pages: DataFrame) -> DataFrame:
    """``doc_id, page_number, word_idx, text, bbox, confidence, symbol_confidences`` of parsed pages."""
    rows = pages.select("doc_id", "page_number", F.posexplode("words").alias("word_idx", "w"))
    return rows.select("doc_id", "page_number", "word_idx", "w.text", "w.bbox", "w.confidence", "w.symbol_confidences")


def detect(images: DataFrame, provider: Callable[[bytes], dict] | None = None) -> DataFrame:
    """``cache_key, text, confidence, languages, words`` of each image (``cache_key, image``), by a recognition service.

    ``provider`` takes the bytes of an image and returns these fields; an error it raises fails the task."""
    if provider is None:
        raise NotInstalled("no recognition service is installed; give a provider, or read cached results")

    sign = pa.struct([("char", pa.string()), ("confidence", pa.float64())])
    word = pa.struct([("text", pa.string()), ("confidence", pa.float64()), ("bbox", pa.list_(pa.list_(pa.float64()))), ("symbol_confidences", pa.list_(sign))])
    schema = pa.schema([("cache_key", pa.string()), ("text", pa.string()), ("confidence", pa.float64()), ("languages", pa.list_(pa.string())), ("words", pa.list_(word))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_pylist([{"cache_key": k, **provider(image)}], schema)

    return images.select("cache_key", "image").mapInArrow(run, _SCANNED)


def rasterize(files: DataFrame, dpi: int = 300) -> DataFrame:
    """``filename, page_number, image`` (PNG) of the pages of PDF files (``filename, content``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            import fitz
        except ImportError as e:
            raise NotInstalled("rasterizing needs a PDF library, which isn't installed; start from page images or words") from e
        zoom = fitz.Matrix(dpi / 72, dpi / 72)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fitz.open(stream=content, filetype="pdf") as doc:
                    for i, page in enumerate(doc, 1):
                        cols = [pa.array([name]), pa.array([i], pa.int32()), pa.array([page.get_pixmap(matrix=zoom).tobytes("png")], pa.binary())]
                        yield pa.RecordBatch.from_arrays(cols, names=["filename", "page_number", "image"])

    return files.select("filename", "content").mapInArrow(run, "filename string, page_number int, image binary")

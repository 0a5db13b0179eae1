"""The document store: batches put over what is there, orphans, statistics.

A later batch replaces a file as a whole. Pages of a file that its last batch doesn't have are
gone; ``orphans`` shows what a store that only adds would keep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import stem

# Columns of the stored tables.
DOCUMENTS = "filename string, source string, year string, pages int, confidence double, quality_score int, recommendation string, date_processed string, metadata string"
PAGES = "filename string, page_number int, text string, confidence double"


def create_tables(spark, prefix: str = "") -> None:
    """Empty tables of the store, if they aren't there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}documents ({DOCUMENTS}) USING parquet")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}pages ({PAGES}) USING parquet")


def unprocessed(inputs: DataFrame, results: DataFrame, force: bool = False) -> DataFrame:
    """Inputs (``filename``) without a result of the same stem."""
    if force:
        return inputs
    done = results.select(stem(F.col("filename")).alias("stem")).distinct()
    return inputs.withColumn("stem", stem(F.col("filename"))).join(done, "stem", "left_anti").drop("stem")


def pilot(inputs: DataFrame, n: int, results: DataFrame, force: bool = False) -> DataFrame:
    """The first ``n`` inputs by name, then those of them without a result."""
    return unprocessed(inputs.orderBy("filename").limit(n), results, force)


def last_batches(batches: DataFrame) -> DataFrame:
    return batches.groupBy("filename").agg(F.max("batch").alias("batch"))


def stored_pages(batches: DataFrame) -> DataFrame:
    """``filename, page_number, text, batch``: what the store has after all batches. Of rows with the same page in one batch the greatest text stays."""
    rows = batches.join(last_batches(batches), ["filename", "batch"])
    return rows.groupBy("filename", "page_number", "batch").agg(F.max("text").alias("text")).select("filename", "page_number", "text", "batch")


def stored_documents(batches: DataFrame) -> DataFrame:
    """``filename, pages, batch``"""
    return stored_pages(batches).groupBy("filename", "batch").agg(F.count("*").alias("pages")).select("filename", "pages", "batch")


def orphans(batches: DataFrame) -> DataFrame:
    """``filename, page_number, batch``: pages of earlier batches of files stored again."""
    old = batches.select("filename", "page_number", "batch").distinct()
    return old.join(last_batches(batches), ["filename", "batch"], "left_anti")


def upsert_documents(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored documents with the new ones in place of those of the same name; both have the stored columns."""
    return stored.join(new.select("filename").distinct(), "filename", "left_anti").unionByName(new)


def upsert_pages(stored: DataFrame, new: DataFrame, documents: DataFrame) -> DataFrame:
    """Stored pages without those of the new documents, and the new pages."""
    return stored.join(documents.select("filename").distinct(), "filename", "left_anti").unionByName(new)


def document_rows(results: DataFrame, date_processed: str) -> DataFrame:
    """Rows to store of built results: the metadata are all but texts, pages and report, as JSON. The year has no source and is empty."""
    meta = F.to_json(F.struct("filename", F.lit(date_processed).alias("date_processed"), "pages", "source", "confidence"))
    return results.select(
        "filename", F.coalesce("source", F.lit("")).alias("source"), F.lit("").alias("year"), F.col("pages").cast("int").alias("pages"), F.round("confidence", 4).alias("confidence"),
        F.coalesce("quality_score", F.lit(0)).alias("quality_score"), F.coalesce("recommendation", F.lit("")).alias("recommendation"), F.lit(date_processed).alias("date_processed"), meta.alias("metadata"),
    )


def latest_runs(results: DataFrame) -> DataFrame:
    """The last successful run of each file; of equal times the greatest row."""
    ok = results.where("error is null")
    rest = [c for c in ok.columns if c not in ("filename", "run_at")]
    best = ok.groupBy("filename").agg(F.max(F.struct("run_at", *rest)).alias("best"))
    return best.select("filename", "best.*").select(*ok.columns)


def stats(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """One row: numbers of documents and pages, mean confidence (0 without any)."""
    docs = documents.agg(F.count("*").alias("total_documents"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence"))
    return docs.join(F.broadcast(pages.agg(F.count("*").alias("total_pages"))))  # one row


def quality_distribution(documents: DataFrame) -> DataFrame:
    return documents.groupBy("recommendation").agg(F.count("*").alias("n"))


def problematic(documents: DataFrame, below: int = 75) -> DataFrame:
    return documents.where(F.col("quality_score") < below).orderBy("quality_score", "filename").select("filename", "source", "confidence", "quality_score", "recommendation")

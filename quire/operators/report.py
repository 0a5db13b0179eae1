"""Results of documents, run statistics and reports.

A run failed if it has an error, an empty one included. Exact duplicates of a row are one run.
Missing scores count as 0 in means and as 100 where documents with low scores are listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import stem

#: Between the pages of a stored text.
PAGE_BREAK = "\n\n--- עמוד ---\n\n"
LOW_SCORE = 75
BAR = "=" * 50


def confidence(c: Column) -> Column:
    """Mean of the confidences that are neither null nor 0; 0 without any. An aggregate."""
    return F.coalesce(F.avg(F.nullif(c, F.lit(0.0))), F.lit(0.0))


def extract_source(filename: Column) -> Column:
    """First part of the name that isn't a number, or the whole name."""
    name = stem(filename)
    parts = F.filter(F.split(F.translate(name, "_-", "  "), r"\s+"), lambda x: (x != "") & ~x.rlike(r"^\p{Nd}+$"))
    return F.coalesce(F.try_element_at(parts, F.lit(1)), name)


def build_results(pages: DataFrame) -> DataFrame:
    """One row for each document of the pages: their number, confidence, joined text and numbered pages, in page order."""
    ordered = F.sort_array(F.collect_list(F.struct("page_number", "page_id", "text", "confidence")))
    docs = pages.groupBy("doc_id").agg(F.min("filename").alias("filename"), F.count("*").alias("pages"), confidence(F.col("confidence")).alias("confidence"), ordered.alias("own"))
    text = F.array_join(F.transform(F.filter("own", lambda p: p.text != ""), lambda p: p.text), PAGE_BREAK)
    numbered = F.transform("own", lambda p, i: F.struct((i + 1).alias("page_number"), F.coalesce(p.text, F.lit("")).alias("text"), F.coalesce(p.confidence, F.lit(0.0)).alias("confidence")))
    return docs.select("doc_id", "filename", "pages", extract_source(F.col("filename")).alias("source"), "confidence", text.alias("text"), numbered.alias("pages_data"))


def document_confidence(pages: DataFrame) -> DataFrame:
    return pages.groupBy("doc_id").agg(F.count("*").alias("pages"), confidence(F.col("confidence")).alias("confidence"))


def runs(results: DataFrame) -> DataFrame:
    return results.distinct()


def successful(results: DataFrame) -> DataFrame:
    return results.where("error is null")


def aggregate(results: DataFrame) -> DataFrame:
    """One row: number of files, sums for the means, confidence bands."""
    c = F.coalesce("confidence", F.lit(0.0))
    return results.agg(
        F.count("*").alias("total"),
        F.avg(c).alias("avg_confidence"),
        F.avg(F.coalesce("quality_score", F.lit(0))).alias("avg_score"),
        F.count_if(c >= 0.9).alias("excellent"),
        F.count_if((c >= 0.8) & (c < 0.9)).alias("good"),
        F.count_if(c < 0.8).alias("problematic"),
    )


def by_recommendation(results: DataFrame) -> DataFrame:
    """``recommendation, n, share``"""
    counts = results.groupBy(F.coalesce("recommendation", F.lit("unknown")).alias("recommendation")).agg(F.count("*").alias("n"))
    total = results.agg(F.count("*").alias("total"))
    return counts.join(F.broadcast(total)).select("recommendation", "n", (F.col("n") / F.col("total")).alias("share"))  # the total is one row


def needing_attention(results: DataFrame, below: int = LOW_SCORE) -> DataFrame:
    """Files with a score below the limit, the lowest first."""
    return results.where(F.col("quality_score") < below).orderBy("quality_score", "filename").select("filename", "source", "confidence", "quality_score", "recommendation")


def summary(results: DataFrame) -> DataFrame:
    """One row: runs that succeeded and failed, and means over those that succeeded."""
    ok = F.col("error").isNull()
    return results.agg(
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        F.avg(F.when(ok, F.coalesce("confidence", F.lit(0.0)))).alias("avg_confidence"),
        F.avg(F.when(ok, F.coalesce("quality_score", F.lit(0)))).alias("avg_score"),
    )


def failures(results: DataFrame) -> DataFrame:
    return results.where("error is not null").select("filename", "error")


def _percent(c: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f%%", c * 100)


def _line(check: str, label: str, value: Column) -> Column:
    status = F.when(F.col(f"{check}.passed"), "PASS").otherwise("FAIL")
    return F.concat(F.lit("  ["), status, F.lit(f"] {label}: "), value.cast("string"))


def file_reports(scored: DataFrame) -> DataFrame:
    """``filename, report`` of a frame with ``filename, pages, confidence`` and the checks and score of the quality operator."""
    lines = [
        F.lit(BAR), F.concat(F.lit("  "), "filename"), F.lit(BAR), F.lit(""),
        F.format_string("  Pages: %s", F.col("pages")), F.concat(F.lit("  Confidence: "), _percent(F.col("confidence"), 2)), F.format_string("  Score: %s/100", F.col("score")), F.concat(F.lit("  Recommendation: "), "recommendation"),
        F.lit(""), F.lit("--- Level 1: Basic Checks ---"),
        _line("hebrew_ratio", "Hebrew ratio", _percent(F.col("hebrew_ratio.ratio"), 1)), _line("weird_chars", "Weird characters", F.col("weird_chars.count")),
        _line("text_length", "Avg chars/page", F.bround("text_length.avg_per_page", 0).cast("long")), _line("spacing", "Spacing errors", F.col("spacing.error_score")),
        F.lit(""), F.lit("--- Level 2: Linguistic Checks ---"),
        _line("final_letters", "Final letter errors", F.col("final_letters.errors")), _line("nikud", "Double nikud", F.col("nikud.double_nikud")),
        _line("grammar", "Single char errors", F.col("grammar.single_char_errors")), _line("grammar", "Repeated chars", F.col("grammar.repeated_chars")),
        F.lit(""), F.lit(BAR),
    ]
    return scored.select("filename", F.concat_ws("\n", *lines).alias("report"))


def aggregate_report(results: DataFrame, generated: str | None = None) -> DataFrame:
    """One row, ``report``: the text over all given runs. The list of low scores is a report's own content; it grows with their number."""
    total = aggregate(results)
    kinds = by_recommendation(results).agg(F.sort_array(F.collect_list(F.format_string("  %s: %d (%.0f%%)", F.col("recommendation"), F.col("n"), F.col("share") * 100))).alias("kinds"))
    low = needing_attention(results).agg(F.sort_array(F.collect_list(F.struct("quality_score", "filename", "confidence"))).alias("low"))
    row = total.join(F.broadcast(kinds)).join(F.broadcast(low))  # one row each
    stamp = F.lit(generated) if generated else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm")
    n = F.col("total")

    def band(label: str, c: str) -> Column:
        return F.concat(F.lit(f"  {label}: "), F.col(c).cast("string"), F.lit(" ("), _percent(F.col(c) / n, 0), F.lit(")"))

    attention = F.transform("low", lambda x: F.format_string("  %s: score=%d, conf=%.2f%%", x.filename, x.quality_score, x.confidence * 100))
    lines = F.concat(
        F.array(
            F.lit(BAR), F.format_string("  OCR Processing Report - %d files", n), F.concat(F.lit("  Generated: "), stamp), F.lit(BAR), F.lit(""), F.lit("--- Statistics ---"),
            F.format_string("  Total files: %d", n), F.concat(F.lit("  Avg confidence: "), _percent(F.col("avg_confidence"), 2)), F.format_string("  Avg quality score: %.0f/100", F.col("avg_score")),
            F.lit(""), F.lit("--- Confidence Distribution ---"), band("Excellent (>90%)", "excellent"), band("Good (80-90%)", "good"), band("Problematic (<80%)", "problematic"), F.lit(""), F.lit("--- Recommendations ---"),
        ),
        F.col("kinds"),
        F.when(F.size("low") > 0, F.concat(F.array(F.lit(""), F.lit("--- Files Needing Attention ---")), attention)).otherwise(F.array().cast("array<string>")),
        F.array(F.lit(""), F.lit(BAR)),
    )
    return row.select(F.when(n > 0, F.array_join(lines, "\n")).otherwise("No files processed.").alias("report"))

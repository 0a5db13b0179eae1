"""Lines that the issues of one publication carry again and again (problem 1).

A line is known by its letters, case-folded. For every line and source the documents that
carry it inside and outside the source are counted over the whole tables; the log-likelihood
ratio of the two frequencies says whether the line belongs to the source, and the
Benjamini-Hochberg procedure over all lines that enough documents of a source carry bounds
the share of false discoveries. Significant lines count as notices of the source.
Lines travel as two 64-bit hashes, their texts never do.

Pages whose document or source is unknown are left out of the counts and keep their text;
null texts give no line but their documents count; a page delivered again changes nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.workspace import narrow, once_per, staged

#: Least letters of a line, least documents that carry it and least share of the source's documents in percent (fixed values of the problem).
LETTERS, DOCUMENTS, PERCENT = 12, 3, 3
#: Bound of the false discoveries; log-likelihood ratios are ranked in steps of 1/STEPS up to MOST.
FALSE, STEPS, MOST = 0.05, 16, 1024


def letters(line: Column) -> Column:
    """Letters of a line; lower case of upper case is the full case folding (``ß`` is ``ss``, a ligature its letters)."""
    return F.lower(F.upper(F.regexp_replace(line, r"\P{L}+", "")))


def _lines(pages: DataFrame) -> DataFrame:
    kept = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line_no"), letters(x).alias("k")))
    kept = F.transform(F.filter(kept, lambda x: F.length(x.k) >= LETTERS), lambda x: F.struct(x.line_no.alias("line_no"), F.xxhash64(x.k).alias("a"), F.xxhash64(F.lit(1), x.k).alias("b")))
    return pages.select("page_id", "doc_id", F.inline(kept))


def _sources(documents: DataFrame) -> DataFrame:
    return documents.where("source is not null").select(F.col("doc_id").cast("string").alias("doc_id"), "source")


def log_likelihood_ratio(n: Column, docs: Column, out: Column, others: Column) -> Column:
    """Twice the log-likelihood ratio of ``n`` of ``docs`` against ``out`` of ``others``; 0 unless the first share is larger."""
    n, docs, out, others = (x.cast("double") for x in (n, docs, out, others))
    share = (n + out) / (docs + others)

    def term(seen: Column, of: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (of * share))).otherwise(0.0) + F.when(of > seen, (of - seen) * F.log((of - seen) / (of * (1 - share)))).otherwise(0.0)

    excess = n * others > out * docs
    return F.when(excess, 2 * (term(n, docs) + F.when(others > 0, term(out, others)).otherwise(0.0))).when(others == 0, 2 * n).otherwise(0.0)


def _tail(ratio: float) -> float:
    """Chance of such a ratio without excess (chi-square of one degree, one side)."""
    return 0.5 * math.erfc(math.sqrt(max(ratio, 0.0) / 2))


def significant(ranked: DataFrame) -> float:
    """Least ratio that is significant, by Benjamini and Hochberg over all rows of ``ratio``: the driver sees their histogram only."""
    step = F.least(F.floor(F.col("ratio") * STEPS), F.lit(MOST * STEPS)).alias("step")
    rows = sorted(((r.step, r.n) for r in ranked.groupBy(step).agg(F.count("*").alias("n")).collect()), reverse=True)
    tests, above, least = sum(n for _, n in rows), 0, math.inf
    for k, n in rows:
        above += n
        if _tail(k / STEPS) <= FALSE * above / tests:
            least = k / STEPS
    return least


def notices(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """``source, a, b, n, ratio``: lines that count as notices of a source."""
    sources = _sources(documents)
    total = pages.select("doc_id").distinct().join(sources, "doc_id").groupBy("source").agg(F.count("*").alias("docs"))
    total = narrow(staged(total))
    every = total.agg(F.sum("docs").alias("all_docs"))
    carried = _lines(pages).select("doc_id", "a", "b").distinct().join(sources, "doc_id")
    counted = carried.groupBy("source", "a", "b").agg(F.count("*").alias("n"))
    # lines of fewer documents than a notice has can't be chosen, whatever their ratio; they aren't tested
    seen = staged(counted)
    # a notice that several publications share is no background for any of them: sources that carry a line often aren't counted outside
    few = F.col("n") < DOCUMENTS
    anywhere = seen.join(total, "source").groupBy("a", "b").agg(F.sum(F.when(few, F.col("n")).otherwise(0)).alias("out"), F.sum(F.when(few, 0).otherwise(F.col("docs"))).alias("carrying"), F.max("n").alias("most"))
    anywhere = anywhere.where(F.col("most") >= DOCUMENTS).select("a", "b", "out", "carrying")
    often = seen.where(F.col("n") >= DOCUMENTS).join(anywhere, ["a", "b"]).join(total, "source").join(F.broadcast(every))
    often = staged(often.select("source", "a", "b", "n", "docs", log_likelihood_ratio(F.col("n"), F.col("docs"), F.col("out"), F.col("all_docs") - F.col("carrying")).alias("ratio")))
    least = significant(often.select("ratio"))
    return often.where((F.col("ratio") >= least) & (F.col("n") * 100 >= F.col("docs") * PERCENT)).select("source", "a", "b", "n", "ratio")


def found(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """``page_id, line_no`` of every notice."""
    known = staged(notices(pages, documents).select("source", "a", "b"))
    sources = _sources(documents)
    hits = _lines(pages).join(narrow(known), ["a", "b"]).select("page_id", "line_no", "doc_id", "source").distinct()
    return hits.join(sources, ["doc_id", "source"]).select("page_id", "line_no")


def cleaned(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """``page_id, text, n_removed``: every page once, its text put together again from the lines that aren't notices, in their order."""
    gone = found(pages, documents).groupBy("page_id").agg(F.collect_set("line_no").alias("gone"))  # at most the lines of one page
    own = once_per(pages.select("page_id", "text"), "page_id").join(gone, "page_id", "left")
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i)), "\n")
    return own.select("page_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))

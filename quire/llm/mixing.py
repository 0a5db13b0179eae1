"""Mixing of publications by target shares of the tokens (problem 8).

Capped water-filling: a source gives its share of the level, at most its tokens times
``max_repeats``; the level rises until the whole budget is given, so that what capped
sources lack is given by the others in proportion to their shares.

The budget is the number of tokens of all sources that have a target, unless another is
named. Documents without a source or with one that has no target are left out; a target
without documents gives nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import tokens
from quire.workspace import narrow, staged

#: A source is cut into so many slices (a power of two) by the hashes of its documents.
SLICE_BITS = 12


def water_fill(shares: list[float], caps: list[float], budget: float) -> list[float]:
    """``min(level * share, cap)`` of each, adding up to the budget or to all that the caps allow."""
    left, weight, level = float(budget), sum(shares), None
    for cap, share in sorted(((c, s) for c, s in zip(caps, shares) if s > 0), key=lambda x: x[0] / x[1]):
        if cap * weight > left * share:
            level = left / weight
            break
        left, weight = left - cap, weight - share
    return [0.0 if s <= 0 else c if level is None else min(level * s, c) for s, c in zip(shares, caps)]


def mix(documents: DataFrame, targets: DataFrame, path: str, budget: int | None = None) -> DataFrame:
    """``doc_id, source, n_tokens, repeats``: how often each document of a source with a target is used."""
    spark = documents.sparkSession
    docs = documents.select("doc_id", "source", "text").join(F.broadcast(targets.select("source")), "source", "left_semi")
    counts = staged(tokens.token_counts(docs, path))
    had = dict(counts.groupBy("source").agg(F.sum("n_tokens")).collect())  # a row for each target at most
    rows = targets.collect()
    have = [had.get(r.source) or 0 for r in rows]
    quotas = water_fill([r.target_share for r in rows], [h * r.max_repeats for h, r in zip(have, rows)], sum(have) if budget is None else budget)
    given = [(r.source, min(int(q // h), r.max_repeats) if h else 0) for r, q, h in zip(rows, quotas, have)]
    plan = spark.createDataFrame([(s, w, float(q - w * h)) for (s, w), q, h in zip(given, quotas, have)], "source string, whole int, rest double")
    # running sum in the order of the hashes, in two steps: over the slices of each source, and within a slice, so that no task has a whole source
    ranked = counts.withColumn("h", F.xxhash64("doc_id")).withColumn("slice", F.shiftrightunsigned("h", 64 - SLICE_BITS).cast("int"))
    slices = ranked.groupBy("source", "slice").agg(F.sum("n_tokens").alias("own"))
    before = F.sum("own").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("own")
    starts = slices.select("source", "slice", before.alias("before"))  # at most 2**SLICE_BITS rows of a source
    within = Window.partitionBy("source", "slice").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    counts = ranked.withColumn("upto", F.sum("n_tokens").over(within)).join(narrow(staged(starts)), ["source", "slice"])
    half = F.col("before") + F.col("upto") - F.col("n_tokens") / 2  # a document is used once more if most of it lies within the rest
    once_more = (F.col("n_tokens") > 0) & (half <= F.col("rest"))
    return counts.join(F.broadcast(plan), "source").withColumn("repeats", F.col("whole") + once_more.cast("int")).select("doc_id", "source", "n_tokens", "repeats")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """One row for each target: the tokens there are, the tokens used and the share reached."""
    by = mixed.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("used_tokens"))
    out = targets.join(by, "source", "left").fillna(0, ["n_tokens", "used_tokens"])
    total = F.sum("used_tokens").over(Window.partitionBy())
    return out.select("source", "target_share", "max_repeats", "n_tokens", "used_tokens", F.try_divide("used_tokens", total).alias("share"))

"""Queries of the training-data operators: each over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import encodings, lookalikes, mixing, neardup, notices, quality, scans, sentences, tokens
from quire.workspace import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def _query(f: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(*(table(spark, sf_dir, n) for n in names))

    return run


def _kinds(f: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return _query(f, "pages", "page_labels", "dictionary", "common_words")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "source_targets"), public_tokenizers.path(VOCABULARY))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(p8_mix(spark, sf_dir), table(spark, sf_dir, "source_targets"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": _query(notices.found, "pages", "documents"),
    "p1_text": _query(notices.cleaned, "pages", "documents"),
    "p2_found": _kinds(quality.found),
    "p2_stats": _query(quality.measured, "pages", "documents", "page_labels", "dictionary", "common_words"),
    "p3_found": _query(scans.found, "pages", "documents", "page_labels", "dictionary", "common_words"),
    "p3_text": _query(scans.repaired, "pages", "documents", "page_labels", "dictionary", "common_words"),
    "p4_found": _query(sentences.found, "pages"),
    "p4_units": _query(sentences.units, "pages"),
    "p5_found": _query(neardup.found, "pages"),
    "p5_groups": _query(neardup.groups, "pages"),
    "p6_found": _kinds(lookalikes.found),
    "p6_text": _query(lookalikes.rewritten, "pages"),
    "p7_ids": p7_ids,
    "p9_found": _query(encodings.found, "documents", "dictionary"),
    "p9_text": _query(encodings.restored, "documents", "dictionary"),
    "p8_shares": p8_shares,
    "p8_mix": p8_mix,
}

#: Problem 1 by exact counting: the lines that the significance test must not lose.
ORACLE: dict[str, str] = {}

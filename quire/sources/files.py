"""Files as tables: inputs, word lists, text and JSON sinks, configuration."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import stem, strip


def list_inputs(spark: SparkSession, folder: str, suffix: str = ".pdf", content: bool = False) -> DataFrame:
    """``path, filename, length, modified`` (and ``content``) of the files of a folder, by path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder)
    cols = ["path", F.regexp_extract("path", "[^/]+$", 0).alias("filename"), "length", F.col("modificationTime").alias("modified"), *(["content"] if content else [])]
    return files.select(*cols).orderBy("path")


def file_metadata(pages: DataFrame) -> DataFrame:
    """``filename, pages`` of rasterized pages."""
    return pages.groupBy("filename").agg(F.count("*").alias("pages"))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """``word``: distinct stripped non-blank lines of a word list; none where there is no such file."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "word string")
    return spark.read.text(path).select(strip(F.col("value")).alias("word")).where("word <> ''").distinct()


def _written(df: DataFrame, folder: str, suffix: str) -> None:
    """One file for each row of ``stem, body``, written by the executors to a folder that they share; a later row replaces an earlier one."""
    jvm = df.sparkSession.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    if fs.getScheme() != "file":
        raise ValueError("files by name are written to a mounted folder; use write_table for object stores")
    root = Path(p.toUri().getPath())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root.mkdir(parents=True, exist_ok=True)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = root / f".{name}{suffix}.part"
                part.write_text(body or "", encoding="utf-8")
                part.replace(root / f"{name}{suffix}")  # whole or not at all, whichever attempt wins
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    df.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def save_txt(results: DataFrame, folder: str) -> None:
    """``stem.txt`` with the text of each result (``filename, text``)."""
    _written(results.select(stem(F.col("filename")).alias("stem"), "text"), folder, ".txt")


def save_json(results: DataFrame, folder: str) -> None:
    """``stem.json`` with all columns of each result, indented, letters as they are."""
    _written(results.select(stem(F.col("filename")).alias("stem"), F.to_json(F.struct(*results.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("body")), folder, ".json")


def save_reports(reports: DataFrame, folder: str) -> None:
    """``stem_report.txt`` of each file report (``filename, report``)."""
    _written(reports.select(F.concat(stem(F.col("filename")), F.lit("_report")).alias("stem"), "report"), folder, ".txt")


def save_aggregate_report(report: DataFrame, folder: str) -> None:
    _written(report.select(F.lit("aggregate_report").alias("stem"), "report"), folder, ".txt")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(path)


@dataclass(frozen=True)
class Config:
    """Settings of a run. Relative paths are taken from ``root``."""

    root: str = "."
    paths: dict[str, str] = field(default_factory=dict)
    processing: dict[str, object] = field(default_factory=lambda: {"parallel_workers": 3, "dpi": 300})
    quality: dict[str, float] = field(default_factory=lambda: {"hebrew_ratio_min": 0.85, "weird_chars_max": 10, "chars_per_page_min": 500, "chars_per_page_max": 5000})
    preprocessing: dict[str, object] = field(default_factory=lambda: {"denoise": True, "binarize": True, "deskew": True, "enhance_contrast": True, "upscale_factor": 2})
    post_processing: dict[str, object] = field(default_factory=dict)

    def path(self, name: str) -> str:
        own = self.paths[name]
        return own if Path(own).is_absolute() or "://" in own else str(Path(self.root) / own)


def load_config(path: str, root: str | None = None) -> Config:
    """A JSON file, or a YAML one where a YAML parser is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML needs a YAML parser, which isn't installed; use JSON") from e
        own = yaml.safe_load(text) or {}
    else:
        own = json.loads(text)
    names = Config.__dataclass_fields__
    return Config(**({"root": root or str(Path(path).parent)} | {k: v for k, v in own.items() if k in names and k != "root"}))

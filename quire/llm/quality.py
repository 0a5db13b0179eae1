"""Text statistics of pages and the kinds of page they tell apart (problem 2).

Each page text is measured in one narrow pass. A Gaussian mixture with diagonal covariances
is fitted by expectation-maximization to the standardized statistics of all pages: each
partition adds up its sufficient statistics, the driver sees one row per component. The
components are mapped to prose, list, table or junk by the labelled pages that fall into
them. The fitted model is a few hundred numbers, so that every later pass can classify the
texts it reads by itself, without a join.

Null, empty and blank texts have no statistics and no kind. A page delivered again counts once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.workspace import once_per, staged

STATS = ["known", "common", "symbols", "word_len", "stops", "items", "rows", "n_words"]
KINDS = ["prose", "list", "table", "junk"]
#: Components of the mixture, rounds of EM, least variance of a standardized statistic, and the labelled pages used at most.
COMPONENTS, ROUNDS, LEAST_VARIANCE, LABELS = 14, 14, 0.02, 20_000
#: Most words of a word list that is sent to the executors (about 100 MB).
LIST_WORDS = 1_000_000

_EDGE = ".,;:!?\"'()[]{}«»„“”‘’…،؟؛。，、！？：；「」『』｢｣·•*~_|/\\<>=+#%&@§°¤¬$^`—–-־׳״፡።፣፧፤।॥፦"
_MARKS = re.compile("[̀-֑ͯ-ׇֽֿׁׂًׅׄ-ْ]+")
_ITEM = re.compile(r"\s*(?:[-*•–‣◦·]\s+\S|\(?\d{1,3}[.)]\s+\S|\(?(?:[^\W\d_]|[א-ת]{2,3}|[ivx]{2,5})\)\s+\S)|.*(?:\.\s?){4,}\s*\d+\s*$|.*…{2,}\s*\d+\s*$")
_CELL = re.compile(r"\t+|(?<=\S) {2,}(?=\S)|(?<=\S)\s+[|;](?=\s)")
_RULE = re.compile(r"\s*[-=─═_+|]{6,}\s*$")
_SYMBOL = re.compile(r"[^\w\s̀-֑ͯ-ׇً-ْऀ-ॣ]|_")
_STOP = re.compile(r"[.!?…:;。！？።፧।؟,،፣、][\"'»“”’)\]」』\s]*$")
_HAN = re.compile("[぀-ヿ㐀-鿿]")
_HANS = re.compile("[぀-ヿ㐀-鿿]+")


class Lexicon:
    """Words of the dictionary and the frequent words; those of scripts without spaces also as one pattern."""

    def __init__(self, words, common):
        self.words = frozenset(w for x in words if x and (w := x.strip().lower()))
        self.common = frozenset(w for x in common if x and (w := x.strip().lower()))
        han = sorted({w for w in self.words | self.common if _HAN.match(w) and len(w) > 1}, key=lambda w: (-len(w), w))
        self._han = re.compile("|".join(map(re.escape, han)) or r"(?!)")
        self._han_common = frozenset(w for w in self.common if _HAN.match(w))

    def stats(self, text: str | None) -> list[float] | None:
        if not text or not (lines := [x for x in text.split("\n") if x.strip()]):
            return None
        low = _MARKS.sub("", text.lower())
        words = [w for x in low.split() if (w := x.strip(_EDGE))]
        known = common = letters = total = 0
        has, frequent = self.words, self.common
        for w in words:
            if w[0] > "〿" and _HAN.search(w):
                for run in _HANS.findall(w):
                    n = len(run)
                    total += n
                    letters += n
                    known += sum(map(len, self._han.findall(run)))
                    common += sum(c in self._han_common for c in run)
            elif not w.isdigit():
                n = len(w)
                total += n
                letters += n
                if w in has:
                    known += n if n > 1 else 0
                    if w in frequent:
                        common += n
        items = sum(1 for x in lines if _ITEM.match(x))
        rows = sum(1 for x in lines if len(_CELL.findall(x)) >= 2 or _RULE.match(x))
        stops = sum(1 for x in lines if _STOP.search(x))
        solid = sum(map(len, text.split())) or 1
        return [
            known / total if total else 0.0,
            common / total if total else 0.0,
            len(_SYMBOL.findall(text)) / solid,
            float(np.log1p(sum(map(len, words)) / len(words))) if words else 0.0,
            stops / len(lines),
            items / len(lines),
            rows / len(lines),
            float(np.log1p(len(words))),
        ]


def word_list(df: DataFrame, column: str = "word", limit: int = LIST_WORDS) -> list[str]:
    """Distinct non-blank words of a fixed list; one beyond ``limit`` words is refused rather than cut."""
    words = [r[0] for r in df.select(F.trim(F.lower(column))).where(F.trim(column) != "").distinct().limit(limit + 1).collect()]
    if len(words) > limit:
        raise ValueError(f"the word list has more than {limit} words; it can't be sent to every executor")
    return words


def lexicon(dictionary: DataFrame, common_words: DataFrame) -> Lexicon:
    return Lexicon(word_list(dictionary), word_list(common_words))


def page_stats(pages: DataFrame, words: Lexicon) -> DataFrame:
    """``page_id`` and the statistics of every page that has text, each page once."""
    shared = pages.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = shared.value.stats
        for batch in batches:
            ids, rows = [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if (s := stats(text)) is not None:
                    ids.append(k)
                    rows.append(s)
            table = np.array(rows, np.float64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(table[:, i]) for i in range(len(STATS)))], names=["page_id", *STATS])

    return once_per(pages.select("page_id", "text").mapInArrow(run, "page_id long, " + ", ".join(f"{s} double" for s in STATS)), "page_id")


@dataclass
class Model:
    """Standardization, mixture, and how far each component is each kind."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    means: np.ndarray
    variances: np.ndarray
    votes: np.ndarray  # component x kind, rows add up to 1
    words: Lexicon | None = None

    def responsibilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of standardized rows; also their log-likelihoods."""
        inv = 1 / self.variances
        logs = np.log(self.weights) - 0.5 * (np.log(self.variances).sum(1) + (self.means**2 * inv).sum(1)) - 0.5 * (x**2) @ inv.T + x @ (self.means * inv).T
        top = logs.max(1, keepdims=True)
        e = np.exp(logs - top)
        total = e.sum(1, keepdims=True)
        return e / total, (top + np.log(total))[:, 0]

    def kinds(self, stats: np.ndarray) -> np.ndarray:
        """Kind numbers of rows of raw statistics."""
        if not len(stats):
            return np.zeros(0, int)
        return (self.responsibilities((stats - self.mean) / self.scale)[0] @ self.votes).argmax(1)

    def kind(self, text: str | None) -> str | None:
        s = self.words.stats(text)
        return None if s is None else KINDS[int(self.kinds(np.array([s]))[0])]


def _spread(points: np.ndarray, k: int) -> np.ndarray:
    """Farthest-first choice of ``k`` of the points, from the one nearest to their median."""
    first = ((points - np.median(points, 0)) ** 2).sum(1).argmin()
    chosen, away = [first], ((points - points[first]) ** 2).sum(1)
    while len(chosen) < k and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _step(stats: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sufficient statistics of one round: weight, sum and sum of squares of each component."""
    d, k = len(STATS), len(model.weights)
    bare = Model(model.mean, model.scale, model.weights, model.means, model.variances, model.votes)
    names = ["r", *(f"s{i}" for i in range(d)), *(f"q{i}" for i in range(d))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, 1 + 2 * d))
        for batch in batches:
            x = (np.stack([c.to_numpy() for c in batch.columns], 1) - bare.mean) / bare.scale
            if len(x):
                r = bare.responsibilities(x)[0]
                total += np.hstack([r.sum(0)[:, None], r.T @ x, r.T @ x**2])
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), *(pa.array(total[:, i].copy()) for i in range(1 + 2 * d))], names=["k", *names])

    parts = stats.select(*STATS).mapInArrow(run, "k int, " + ", ".join(f"{n} double" for n in names))
    rows = sorted(parts.groupBy("k").agg(*(F.sum(n).alias(n) for n in names)).collect())
    total = np.array([r[1:] for r in rows]).reshape(-1, 1 + 2 * d)
    return total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :]


def fit(stats: DataFrame, labels: DataFrame, words: Lexicon | None = None) -> Model:
    """Mixture of all pages' statistics (a staged table), mapped to kinds by the labelled ones."""
    d = len(STATS)
    row = stats.agg(*(F.avg(s) for s in STATS), *(F.stddev_pop(s) for s in STATS)).first()
    mean = np.array([x or 0.0 for x in row[:d]])
    scale = np.array([x if x and x > 1e-9 else 1.0 for x in row[d:]])
    named = labels.where(F.col("kind").isin(KINDS)).select("page_id", "kind").dropDuplicates(["page_id"])
    seen = stats.join(named, "page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(LABELS).select("kind", *STATS).collect()
    if not seen:
        votes = np.eye(1, len(KINDS))
        return Model(mean, scale, np.ones(1), np.zeros((1, d)), np.ones((1, d)), votes, words)
    points = (np.array([r[1:] for r in seen]) - mean) / scale
    kind = np.array([KINDS.index(r[0]) for r in seen])
    centres = _spread(points, COMPONENTS)
    k = len(centres)
    model = Model(mean, scale, np.full(k, 1 / k), centres, np.full((k, d), 0.5), np.zeros((k, len(KINDS))), words)
    for _ in range(ROUNDS):
        n, s, q = _step(stats, model)
        n = n + 1e-6
        means = (s + 1e-6 * model.means) / n[:, None]
        variances = np.maximum(q / n[:, None] - means**2, LEAST_VARIANCE)
        moved = np.abs(means - model.means).max()
        model.weights, model.means, model.variances = n / n.sum(), means, variances
        if moved < 0.01:
            break
    r = model.responsibilities(points)[0]
    votes = r.T @ np.eye(len(KINDS))[kind]
    away = ((model.means[:, None, :] - points[None]) ** 2).sum(2)  # a component without labelled pages is as the nearest one is
    for c in range(k):
        if votes[c].sum() < 0.5:
            votes[c] = np.eye(len(KINDS))[kind[away[c].argmin()]]
    model.votes = votes / votes.sum(1, keepdims=True)
    return model


def fitted(pages: DataFrame, labels: DataFrame, dictionary: DataFrame, common_words: DataFrame) -> tuple[Model, DataFrame]:
    words = lexicon(dictionary, common_words)
    stats = staged(page_stats(pages, words))
    return fit(stats, labels, words), stats


def kinds(stats: DataFrame, model: Model) -> DataFrame:
    """The statistics of each page with its ``kind``."""
    bare = Model(model.mean, model.scale, model.weights, model.means, model.variances, model.votes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy() for c in batch.columns[1:]], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([KINDS[i] for i in bare.kinds(x)], pa.string())], names=[*batch.schema.names, "kind"])

    return stats.select("page_id", *STATS).mapInArrow(run, "page_id long, " + ", ".join(f"{s} double" for s in STATS) + ", kind string")


def found(pages: DataFrame, labels: DataFrame, dictionary: DataFrame, common_words: DataFrame) -> DataFrame:
    model, stats = fitted(pages, labels, dictionary, common_words)
    return kinds(stats, model).where("kind <> 'prose'").select("page_id", "kind")


def measured(pages: DataFrame, documents: DataFrame, labels: DataFrame, dictionary: DataFrame, common_words: DataFrame) -> DataFrame:
    """One row for each page with text: its statistics, its kind and the stored ``quality_score`` of its document."""
    model, stats = fitted(pages, labels, dictionary, common_words)
    docs = once_per(pages.select("page_id", "doc_id"), "page_id").join(documents.select(F.col("doc_id").cast("string").alias("doc_id"), "quality_score"), "doc_id", "left")
    return kinds(stats, model).join(docs, "page_id")

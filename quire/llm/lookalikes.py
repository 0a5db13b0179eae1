"""Texts brought to one consistent form (problem 6).

Strings that look the same form classes: union-find over pairs of strings and code points,
so that the relation is transitive (a full-width letter, a letter of another script and the
plain letter are one class). The pairs come from the Unicode data (compatibility and
canonical decompositions, invisible characters, spaces) and from a list of letters that
scripts share. Each class is represented by its ordinary member; where several scripts have
one, the script that most of a word's distinctive letters belong to decides, and between
equal scripts the more frequent letters of the corpus. Texts are rewritten greedily, longest
match first, with an automaton over all other members.

Null texts stay null, empty ones empty. Lines are never joined or split. A page delivered
again gives the same rows once.
"""

from __future__ import annotations

import re
import sys
import unicodedata as u
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import quality
from quire.workspace import narrow, once_per, staged

# Letters that look alike in the Latin, Cyrillic and Greek scripts ("-": none).
SHARED = """
aаα cсϲ dԁ- eе- hһ- iіι jјϳ lӏ- oоο pрρ qԛ- sѕ- uυυ vѵν wԝ- xхχ yуγ kкκ
AАΑ BВΒ CСϹ EЕΕ HНΗ IІΙ JЈͿ KКΚ MМΜ NͶΝ OОΟ PРΡ SЅ- TТΤ XХΧ YУΥ ZΖΖ
ëё- Ëё- ïїϊ ÏЇΪ
"""
_TAGS = {"", "<wide>", "<narrow>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>", "<font>"}
#: Blocks whose ordinary letters have compatibility decompositions (Thai to Tibetan), and Hangul.
_LEFT_OUT = ((0x0E00, 0x0FFF), (0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7FF))


def script(c: str) -> str:
    return "L" if u.name(c, "").startswith("LATIN") else "C" if u.name(c, "").startswith("CYRILLIC") else "G" if u.name(c, "").startswith("GREEK") else ""


class UnionFind:
    def __init__(self):
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        up = self.up
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _pairs() -> Iterator[tuple[str, str]]:
    """Strings that look alike, from the Unicode data: (other form, ordinary form)."""
    for code in range(0x80, 0x1F000):
        if 0x3400 <= code < 0xA000 or any(a <= code <= b for a, b in _LEFT_OUT) or 0xD800 <= code < 0xF900:
            continue
        c = chr(code)
        kind = u.category(c)
        if kind == "Cf" and not (0x600 <= code <= 0x605 or code in (0x6DD, 0x70F, 0x8E2)) or kind == "Mn" and (0xFE00 <= code <= 0xFE0F or code == 0x34F):
            yield c, ""
        elif kind in ("Zs", "Zl", "Zp"):
            yield c, " "
        elif parts := u.decomposition(c):
            tag = parts.split()[0] if parts[0] == "<" else ""
            plain, composed = u.normalize("NFKC", c), u.normalize("NFC", c)
            if not tag:
                if composed != c:
                    yield c, composed
                if (apart := u.normalize("NFD", c)) != composed:
                    yield apart, composed
                if len(parts.split()) == 2 and (half := u.normalize("NFC", apart[:-1]) + apart[-1]) not in (apart, composed):
                    yield half, composed
            elif tag in _TAGS and plain != c and all(u.category(x)[0] in "LM" or u.category(x) == "Nd" for x in plain) and (kind[0] in "LM" or kind in ("Nd", "Nl") or kind == "So" and len(plain) == 1):
                yield c, plain


class Forms:
    """Classes of look-alike strings, their representatives and the automaton that rewrites the others."""

    def __init__(self, counts: dict[str, int]):
        classes = UnionFind()
        pairs = list(_pairs())
        for a, b in pairs:
            classes.join(a, b)
        shared = [[c for c in group if c != "-"] for group in SHARED.split()]
        for group in shared:
            for c in group[1:]:
                classes.join(group[0], c)
        members: dict[str, list[str]] = {}
        for x in classes.up:
            members.setdefault(classes.find(x), []).append(x)
        other, letters = {a for a, _ in pairs}, {c for group in shared for c in group}
        self.by_script: dict[str, dict[str, str]] = {}  # letter -> script -> letter of that script that looks the same
        rewrite: dict[str, str] = {}
        for group in members.values():
            ordinary = sorted((x for x in group if x not in other), key=lambda x: (-min((counts.get(c, 0) for c in x), default=0), x))
            for x in group:
                if x in other:  # within a class of several scripts the nearest ordinary form is that of its own decomposition
                    own = next((b for b in [u.normalize("NFC", u.normalize("NFKC", x))] if b in ordinary), ordinary[0] if ordinary else u.normalize("NFC", x))
                    if own != x:
                        rewrite[x] = own
            for x in group:
                if x in letters:
                    self.by_script[x] = {}
                    for y in reversed(ordinary):
                        if len(y) == 1 and (s := script(y)):
                            self.by_script[x][s] = y
        self.rewrite, self.counts = rewrite, {c: counts.get(c, 0) for c in letters}
        self._build()

    def _build(self) -> None:
        singles = "".join(re.escape(x) for x in self.rewrite if len(x) == 1 and x < "\U00010000")
        self._odd = re.compile(f"[{singles}\U00010000-\U0001efff]").search  # code points beyond 16 bits as one range: the set stays a bitmap
        self._mixed = re.compile("[A-Za-zÀ-ɏ][Ͱ-ԯ]|[Ͱ-Ͽ][A-Za-zÀ-ɏЀ-ԯ]|[Ѐ-ԯ][A-Za-zÀ-ɏͰ-Ͽ]").search
        self._words = re.compile(r"[^\W\d_]+").sub
        self.automaton = ahocorasick.Automaton()
        for x, y in self.rewrite.items():
            self.automaton.add_word(x, (len(x), y))
        self.automaton.make_automaton()

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("by_script", "rewrite", "counts")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._build()

    def suspect(self, text: str) -> bool:
        return not text.isascii() and (self._odd(text) is not None or not u.is_normalized("NFC", text) or self._mixed(text) is not None)

    def _word(self, m: re.Match) -> str:
        word = m[0]
        if not self._mixed(word):
            return word
        sure, unsure = Counter(), Counter()
        for c in word:
            if s := script(c):
                if c in self.by_script and len(self.by_script[c]) > 1:
                    unsure[s] += 1
                else:
                    sure[s] += 1
        best = max("LCG", key=lambda s: (sure[s], unsure[s], sum(self.counts.get(self.by_script[c].get(s, ""), 0) for c in word if c in self.by_script)))
        return "".join(self.by_script.get(c, {}).get(best, c) if script(c) not in ("", best) else c for c in word)

    def line(self, text: str) -> str:
        """The consistent form of a text."""
        if not self.suspect(text):
            return text
        for _ in range(8):
            out, at = [], 0
            for end, (n, to) in self.automaton.iter_long(text):
                out += (text[at : end + 1 - n], to)
                at = end + 1
            new = u.normalize("NFC", "".join(out) + text[at:])
            if new == text:
                break
            text = new
        return self._words(self._word, text) if self._mixed(text) else text


def frequencies(pages: DataFrame) -> dict[str, int]:
    """How often each character stands in the page texts; at most as many rows as there are characters."""
    counts = pages.groupBy("page_id").agg(F.count("*").alias("n"), F.min("ingested_at").alias("first")).where("n > 1")
    again = narrow(staged(counts.select("page_id", "first")))
    once = pages.select("page_id", "ingested_at", "text").join(again, "page_id", "left").where("first is null or ingested_at = first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(text)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string()), pa.array(seen.values(), pa.int64())], names=["c", "n"])

    total = once.select("text").mapInArrow(run, "c string, n long").groupBy("c").agg(F.sum("n").alias("n"))
    return dict(total.limit(sys.maxunicode + 1).collect())


def forms(pages: DataFrame) -> Forms:
    return Forms(frequencies(pages))


def consistent(pages: DataFrame, own: Forms, text: str = "text") -> DataFrame:
    """The input with its text column in the consistent form."""
    shared = pages.sparkSession.sparkContext.broadcast(own)
    at = pages.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = shared.value.line
        for batch in batches:
            new = pa.array([x if x is None else line(x) for x in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.field(at).name, new)

    return pages.mapInArrow(run, pages.schema)


def found(pages: DataFrame, labels: DataFrame, dictionary: DataFrame, common_words: DataFrame) -> DataFrame:
    """``page_id, line_no`` of the lines that the rewriting changes, on pages that aren't junk."""
    model, _ = quality.fitted(pages, labels, dictionary, common_words)
    shared = pages.sparkSession.sparkContext.broadcast((forms(pages), model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kinds = shared.value
        for batch in batches:
            ids, at = [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text or not own.suspect(text):
                    continue
                hits = [i for i, x in enumerate(text.split("\n")) if own.suspect(x) and own.line(x) != x]
                if hits and kinds.kind(text) not in (None, "junk"):
                    ids += [k] * len(hits)
                    at += hits
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int32())], names=["page_id", "line_no"])

    return pages.select("page_id", "text").mapInArrow(run, "page_id long, line_no int").distinct()


def rewritten(pages: DataFrame) -> DataFrame:
    """``page_id, text``: every page once, its text in the consistent form."""
    return once_per(consistent(pages.select("page_id", "text"), forms(pages)), "page_id")

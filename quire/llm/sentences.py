"""Sentence units of texts in many languages and scripts (problem 4).

A pushdown automaton reads the signs of each line: quotations and brackets are pushed and
popped, terminators inside them don't end the sentence outside, and a quotation that opened
the sentence ends it with its own terminator unless a comma, a dash or a small letter goes on.
A single point is looked up in a trie of abbreviations, read backwards; initials, enumerators,
ordinals and decimals don't end a sentence, and scripts with a terminator of their own end
with that only.

Where a script has no capitals, an ellipsis or an "and so on" may stand inside or at the end.
That is decided by the numbers of words before and after it, with a table counted over all
lines of the corpus whose script shows the answer by its capitals.

Every line break ends a unit; blank lines give none; null and empty texts give no rows. A page
delivered again gives its units once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Abbreviations that never end a sentence, and those that end it when a capital follows (without their last point).
NEVER = """
dr prof mr mrs ms st sr sra srta mme mlle hr fr cf vs e.g i.e z z. b b d h d. h bzw av p. ex ex p. ej ej
ee ee. uu uu jr inkl evtl ggf vgl rev gen col capt lt sgt hon
т т. е е ул см проф им г гл рис д-р
ד פרופ ח.ל מ.ק א. ב ב م د أ ዓ.ም አ.አ ዶ/ር
"""
# Those that are abbreviations before a number only.
NUMBERED = "p pp no nr núm pág vol approx ca env aprox art s с стр fig ed chap tome tel ص ቁ".split()
FINAL = ["etc", "co", "ltd", "inc", "p.m", "a.m", "usw", "u. a", "u.a", "т. д", "т. п", "и др", "א.א.וו", "א.א.װ", "וכו", "וכד", "וגו"]
MONTHS = ("januar", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember")
#: Words on either side that the table tells apart.
SPAN = 40

_OPEN = {"(": ")", "[": "]", "（": "）", "«": "»", "„": "“”", "「": "」", "『": "』", "“": "”", "‹": "›"}
_CLOSE = set(")]）»”」』›")
_BRACKETS = set("([（")
_TERMS = set(".!?…。！？።፧؟।॥｡")
_GO_ON = set(",،、，፣;:؛—–-")
_SIGN = re.compile(r'[.!?…。！？።፧؟।॥｡"“”„«»()\[\]（）「」『』‹›]').finditer
_ENUMERATOR = re.compile(r"\s*\(?(?:\d{1,3}|[^\W\d_]|[א-ת]{2,3})\Z").match
_OWN = re.compile("[ऀ-ॿ፩-፼ሀ-፟぀-ヿ㐀-鿿]")
_WIDE = re.compile("[　-〿぀-ヿ㐀-鿿！-／：-＠［-｀｛-･]")


def _trie() -> dict:
    root: dict = {}
    words, tokens = [], NEVER.split()
    i = 0
    while i < len(tokens):  # "z. b" and the like are one entry of two tokens
        two = tokens[i].endswith(".") and i + 1 < len(tokens)
        words.append((" ".join(tokens[i : i + 2]) if two else tokens[i], "never"))
        i += 2 if two else 1
    for word, kind in words + [(w, "number") for w in NUMBERED] + [(w, "final") for w in FINAL]:
        node = root
        for c in reversed(word):
            node = node.setdefault(c, {})
        node[""] = kind
    return root


class Splitter:
    def __init__(self, table: dict[tuple[str, int, int], tuple[int, int]] | None = None):
        self.trie, self.table = _trie(), table or {}

    def abbreviation(self, low: str, dot: int) -> str | None:
        """Of the longest entry that ends before the point and starts a word."""
        node, i, kind = self.trie, dot - 1, None
        while i >= 0 and (node := node.get(low[i])) is not None:
            if "" in node and (i == 0 or _WIDE.match(low[i - 1]) or not (low[i - 1].isalnum() or low[i - 1] == "'")):
                kind = node[""]
            i -= 1
        return kind

    def _point(self, line: str, low: str, i: int) -> str | None:
        """What a single point is: None for a terminator."""
        if i == 0:
            return "never"
        before = line[i - 1]
        if _OWN.match(before) or line[i + 1 : i + 2].isalnum() and not _WIDE.match(line[i + 1]):
            return "never"
        if _ENUMERATOR(line[:i]):
            return "never"
        kind = self.abbreviation(low, i)
        if kind == "number":
            return "never" if (after := line[i + 1 :].lstrip()[:1]).isnumeric() or after.islower() else None
        if kind:
            return kind
        if before.isalpha() and not before.islower() and (i == 1 or _WIDE.match(line[i - 2]) or not line[i - 2].isalnum() and line[i - 2] not in "'\"׳״ְֱֲֳִֵֶַָֹֻּׁׂ"):
            return "never"  # an initial
        if before.isdigit() and low[i + 1 :].lstrip().startswith(MONTHS) and re.search(r"(?<!\d)\d{1,2}\Z", line[:i]):
            return "never"
        return None

    def marks(self, line: str, without: frozenset = frozenset()) -> list[tuple[int, str, str]]:
        """``(end, what, type)`` in order: ``B`` ends a sentence, ``e`` and ``m`` are doubtful signs that capitals show to end it or not, ``?`` those that nothing shows."""
        low, out, stack, start, skip = line.lower(), [], [], 0, -1
        if len(low) != len(line):
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in line)
        n = len(line)
        for m in _SIGN(line):
            i = m.start()
            if i < skip:
                continue
            c = line[i]
            if c not in _TERMS:
                if c == '"':
                    inside = i and i + 1 < n and line[i - 1].isalpha() and line[i + 1].isalpha()
                    if inside:
                        continue
                    closes = stack and stack[-1][0] == '"'
                    opens = not closes and (i == 0 or not line[i - 1].isalnum() and line[i - 1] not in _TERMS)
                else:
                    closes = bool(stack) and c in stack[-1][0]
                    opens = not closes and c in _OPEN
                if closes:
                    _, at, at_start = stack.pop()
                    if stack:
                        continue
                    inner = line[at + 1 : i].rstrip()
                    if not inner or inner[-1] not in _TERMS:
                        continue
                    rest = line[i + 1 :].lstrip()
                    if not rest:
                        continue
                    d = rest[0]
                    e = rest[1:].lstrip()[:1] if d in _OPEN or d == '"' else d
                    if d in _GO_ON or d in _TERMS or e.islower() or d in _CLOSE:
                        continue
                    if at_start or e.isupper() and e.lower() != e:
                        out.append((i + 1, "B", ""))
                        start = i + 1
                elif opens and i not in without:
                    stack.append(('"' if c == '"' else _OPEN[c], i, not line[start:i].strip()))
                continue
            j = i + 1
            while j < n and line[j] in _TERMS:
                j += 1
            skip, run = j, line[i:j]
            if stack:
                continue
            while j < n and (line[j] in _CLOSE or line[j] == '"' and not line[j + 1 : j + 2].isalnum()):
                j += 1
            dots = run.strip(".") == ""
            if dots and len(run) > 4:  # leaders
                continue
            rest = line[j:].lstrip()
            if not rest:
                continue
            d = rest[0]
            quote = d in _OPEN and d not in _BRACKETS or d == '"'
            e = rest.lstrip('"“„«「『‹([（ ')[:1] if quote or d in _BRACKETS else d
            kind = ""
            if run == ".":
                what = self._point(line, low, i)
                if what == "never":
                    continue
                kind = "final" if what else ""
            elif dots or run == "…":
                kind = "ellipsis"
            if d in _GO_ON:
                continue
            if run[-1] in ".!?" and not line[j : j + 1].isspace() and not _WIDE.match(line[j : j + 1] or " ") and not (i and _WIDE.match(line[i - 1])):
                continue
            if e.islower():
                if kind:
                    out.append((j, "m", kind))
                continue
            if not kind:
                out.append((j, "B", ""))
            elif e.isupper():
                out.append((j, "e", kind))
            elif quote or kind == "final" and e.isdigit():
                out.append((j, "B", ""))
            else:
                out.append((j, "?", kind))
            if out[-1][1] in "Be":
                start = j
        if stack:  # a sign without its partner: read the line again as if it weren't there
            return self.marks(line, without | {stack[0][1]})
        return out

    @staticmethod
    def words(line: str, marks: list[tuple[int, str, str]]) -> list[int]:
        """Number of words up to each mark and up to the end of the line."""
        total, at, out = 0, 0, []
        for end, _, _ in marks:
            total += len(line[at:end].split())
            at = end
            out.append(total)
        return [*out, total + len(line[at:].split())]

    def evidence(self, line: str) -> Iterator[tuple[str, int, int, bool]]:
        marks = self.marks(line)
        if any(k in "em" for _, k, _ in marks):
            n, last = self.words(line, marks), 0
            for i, (_, what, kind) in enumerate(marks):
                if what in "em":
                    yield kind, min(n[i] - last, SPAN), min(n[i + 1] - n[i], SPAN), what == "m"
                if what in "Be":
                    last = n[i]

    def inside(self, kind: str, before: int, after: int) -> bool:
        mid, total = self.table.get((kind, min(before, SPAN), min(after, SPAN)), (0, 0))
        prior = 0.9 if min(before, after) < 6 else 0.2
        return (mid + prior) / (total + 1) > 0.5

    def ends(self, line: str) -> list[int]:
        """Ends of the units of one line, its own last non-blank character included."""
        whole = len(line.rstrip())
        if not line.strip():
            return []
        marks = self.marks(line)
        if any(what == "?" for _, what, _ in marks):
            n, last, kept = self.words(line, marks), 0, []
            for i, (end, what, kind) in enumerate(marks):
                if what in "Be" or what == "?" and not self.inside(kind, n[i] - last, n[i + 1] - n[i]):
                    kept.append(end)
                    last = n[i]
        else:
            kept = [end for end, what, _ in marks if what in "Be"]
        return [*(x for x in kept if x < whole), whole]

    def units(self, text: str | None) -> Iterator[tuple[int, int]]:
        """``start, end`` of each unit in code points, in reading order."""
        at = 0
        for line in (text or "").split("\n"):
            begin = 0
            for end in self.ends(line):
                while line[begin].isspace():
                    begin += 1
                yield at + begin, at + end
                begin = end
            at += len(line) + 1


def counted(texts: DataFrame) -> dict[tuple[str, int, int], tuple[int, int]]:
    """The table of doubtful signs over all texts (column ``text``); it has at most two times SPAN squared entries."""
    bare = Splitter()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in text.split("\n"):
                    seen.update(bare.evidence(line))
        rows = [(*k, n) for k, n in seen.items()]
        cols = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.int64()))], names=["kind", "before", "after", "mid", "n"])

    doubtful = texts.select("text").where(F.col("text").rlike(r"\.\.\.|…|(?i)\b(etc|usw|p\.m|a\.m|u\. a|т\. д|т\. п|co)\."))
    rows = doubtful.mapInArrow(run, "kind string, before int, after int, mid boolean, n long").groupBy("kind", "before", "after")
    rows = rows.agg(F.sum(F.when(F.col("mid"), F.col("n")).otherwise(0)).alias("mid"), F.sum("n").alias("n")).collect()
    return {(r.kind, r.before, r.after): (r.mid, r.n) for r in rows}


def _shared(pages: DataFrame):
    return pages.sparkSession.sparkContext.broadcast(Splitter(counted(pages)))


def found(pages: DataFrame) -> DataFrame:
    """``page_id, end_pos`` of the units of every proofed page."""
    pages = pages.where("stage = 'proofed'")
    shared = _shared(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = shared.value.units
        for batch in batches:
            ids, ends = [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = [e for _, e in units(text)]
                ids += [k] * len(at)
                ends += at
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ends, pa.int32())], names=["page_id", "end_pos"])

    return pages.select("page_id", "text").mapInArrow(run, "page_id long, end_pos int").distinct()


def units(pages: DataFrame) -> DataFrame:
    """``page_id, unit_no, start_pos, end_pos, unit``: the sentence units of every page, raw ones line by line as printed."""
    shared = _shared(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = shared.value.units
        for batch in batches:
            out = [(k, i, a, b, text[a:b]) for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for i, (a, b) in enumerate(split(text))]
            cols = zip(*out) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()))], names=["page_id", "unit_no", "start_pos", "end_pos", "unit"])

    rows = pages.select("page_id", "text").mapInArrow(run, "page_id long, unit_no int, start_pos int, end_pos int, unit string")
    return rows.dropDuplicates(["page_id", "unit_no"])

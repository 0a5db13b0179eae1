"""Repair of text from raw scans (problem 3): broken words, misread letters, running headers, page numbers.

One narrow pass over the raw pages brings each text to the consistent form, leaves junk pages
out and emits what needs evidence from elsewhere: edge lines, broken words that the
dictionary completes, and words it doesn't know. The rest is SQL.

Misread words: every word has an anagram hash, the sum of the hashes of its signs. Where one
letter was read as another sign or as two, the hashes of the unknown word and of the right one
are equal once the sign (or both signs) and the letter are taken off; the difference is that
of the confusion. An equi-join on these keys and the position finds all candidates. Confusions
are ranked by the number of different words they explain without a rival; a word is corrected
when the confusions that hold leave exactly one candidate.

Pages without text give nothing; a page delivered again changes nothing; unknown page numbers
never make a header.
"""

from __future__ import annotations

import re
import unicodedata as u
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import lookalikes, notices, quality
from quire.workspace import narrow, once_per, staged

#: Least letters of a header and of a misread word, share of the raw pages that carry a header (one in RAW_SHARE).
HEADER_LETTERS, WORD_LETTERS, RAW_SHARE = 8, 5, 5
#: A confusion holds that explains so many different words, and this share of what is read for its letter.
WORDS, SHARE = 3, 0.005

HYPHENS = "-‐¬־­"
# Words and signs for "page", in the languages of the texts.
PAGE_WORDS = ["page", "p", "pp", "pg", "seite", "s", "pág", "pag", "página", "стр", "с", "страница", "עמוד", "עמ", "ע", "דף", "זייט", "ז", "ص", "صفحة", "ገጽ", "पृ", "पृष्ठ", "頁", "ページ", "页"]
NUMERALS = dict(zip("אבגדהוזחטיכלמנסעפצקרשת", [*range(1, 10), *range(10, 100, 10), 100, 200, 300, 400]))
_NUMBER = r"(?:\d{1,4}|[一二三四五六七八九十百〇零]{1,5}|[፩-፼]{1,4})"
_LETTERS = r"(?:(?:ת{0,2}[קרשת])?['\"׳״]?(?:ט['\"׳״]?[וז]|[יכלמנסעפצ]?['\"׳״]?[א-ט]?)['\"׳״]?|[ivxlc]{1,7})"
_PAGE = re.compile(
    rf"[\W_]*(?:第\s*{_NUMBER}\s*[页頁]|{_NUMBER}\s*(?:页|頁|ページ)|(?P<word>(?:{'|'.join(sorted(PAGE_WORDS, key=len, reverse=True))})(?:[.'׳:]+\s*|\s+|(?=\d)))?(?P<n>{_NUMBER}|{_LETTERS})"
    rf"(?:\s*(?:/|⁄|\||of|von|de|из|sur|מתוך|פון|من|से)\s*{_NUMBER})?)[\W_]*"
).fullmatch
_EMIT = "page_id long, doc_id string, page_number int, line_no int, kind string, printed string, word string, a long, b long"


def letters(line: str) -> str:
    return "".join([c for c in line if c.isalpha()]).casefold()


class Reader:
    """What one raw page says by itself."""

    def __init__(self, own: lookalikes.Forms, model: quality.Model):
        self.own, self.model = own, model

    def page_number(self, line: str, number: int | None) -> bool:
        """Letters count as numerals beside a word for page, as a lone Hebrew letter, or where they aren't a word or are the page's own number."""
        if len(line) > 40 or not (m := _PAGE(line.strip().lower())):
            return False
        n = m["n"]
        if n is None or any(c.isnumeric() for c in n):
            return True
        bare = re.sub(r"\W", "", n)
        if not bare:
            return False
        hebrew = sum(NUMERALS.get(c, 0) for c in bare)
        return bool(hebrew and (m["word"] or len(bare) == 1)) or len(bare) > 1 and bare not in self.model.words.words or bool(hebrew) and hebrew == number

    def rows(self, text: str | None, number: int | None) -> Iterator[tuple]:
        """``line_no, kind, printed, word, a, b``"""
        if not text or self.model.kind(text) in (None, "junk"):
            return
        words = self.model.words.words
        lines = self.own.line(text).split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip()]
        for i in sorted({*solid[:2], *solid[-2:]}):
            if self.page_number(lines[i], number):
                yield i, "page_number", "", "", 0, 0
            elif len(k := letters(lines[i])) >= HEADER_LETTERS and sum(any(map(str.isalpha, w)) for w in lines[i].split()) >= 2:
                h = xxhash.xxh128_intdigest(k.encode())
                yield i, "edge", "", "", (h & (1 << 64) - 1) - (1 << 63), (h >> 64) - (1 << 63)
        tail = False
        for i, line in enumerate(lines):
            low = line.lower()
            if not low.isascii():
                low = quality._MARKS.sub("", low)
            tokens = low.split()
            if not tokens:
                continue
            first, tail = (1 if tail else 0), False
            last = tokens[-1]
            if len(last) > 1 and last[-1] in HYPHENS and i + 1 < len(lines) and (after := lines[i + 1].split()) and any(map(str.isalpha, last)):
                tail = True
                head = last.rstrip(HYPHENS).strip(quality._EDGE)
                rest = quality._MARKS.sub("", after[0].lower()).strip(quality._EDGE)
                whole = head + rest if head + rest in words else f"{head}-{rest}" if f"{head}-{rest}" in words else None
                if whole and head and rest:
                    yield i, "hyphen", last, whole, 0, 0
            for w in tokens[first : -1 if tail else None]:
                if len(w) >= WORD_LETTERS and w not in words and len(x := w.strip(quality._EDGE)) >= WORD_LETTERS and x not in words:
                    if sum(map(str.isalpha, x)) >= WORD_LETTERS - 2 and not quality._HAN.search(x):
                        yield i, "unknown", x, "", 0, 0


def observed(pages: DataFrame, own: lookalikes.Forms, model: quality.Model) -> DataFrame:
    shared = pages.sparkSession.sparkContext.broadcast(Reader(own, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _EMIT.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            out = [(k, doc, n, *row) for k, doc, n, text in zip(*(c.to_pylist() for c in batch.columns)) for row in shared.value.rows(text, n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(names), kinds)], names=names)

    return pages.where("stage = 'ocr'").select("page_id", "doc_id", "page_number", "text").mapInArrow(run, _EMIT)


def _value(sign: Column) -> Column:
    return F.pmod(F.xxhash64(sign), F.lit(1 << 40))


def _keys(word: str, most: int) -> Column:
    """``key, at, sign`` of a word: its anagram hash without one sign, or without two neighbours."""
    signs = F.split(F.col(word), "")
    total = F.aggregate(F.transform(signs, _value), F.lit(0).cast("long"), lambda x, y: x + y)
    one = F.transform(signs, lambda c, i: F.struct((total - _value(c)).alias("key"), i.alias("at"), c.alias("sign")))
    if most == 1:
        return one
    pairs = F.sequence(F.lit(1), F.length(word) - 1)
    two = F.transform(
        pairs,
        lambda i: F.struct((total - _value(F.substring(F.col(word), i, F.lit(1))) - _value(F.substring(F.col(word), i + 1, F.lit(1)))).alias("key"), (i - 1).alias("at"), F.substring(F.col(word), i, F.lit(2)).alias("sign")),
    )
    return F.concat(one, F.when(F.length(word) > 1, two).otherwise(F.array().cast("array<struct<key:bigint,at:int,sign:string>>")))


def corrections(unknown: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``printed, word``: the one word that each misread word can stand for. ``unknown`` has ``printed`` and its number ``n``."""
    known = dictionary.select(F.trim(F.lower("word")).alias("word")).where(F.length(F.regexp_replace("word", r"\P{L}", "")) >= WORD_LETTERS).distinct()
    known = staged(known.select("word", F.inline(_keys("word", 1))).withColumnRenamed("sign", "letter"))
    tried = unknown.select("printed", "n", F.inline(_keys("printed", 2)))
    after = F.col("at") + F.lit(1)
    same = (F.substring(F.col("printed"), F.lit(1), F.col("at")) == F.substring(F.col("word"), F.lit(1), F.col("at"))) & (
        F.substring(F.col("printed"), after + F.length("sign"), F.length("printed")) == F.substring(F.col("word"), after + 1, F.length("word"))
    )
    candidates = staged(tried.join(narrow(known), ["key", "at"]).where(same & (F.col("sign") != F.col("letter"))).select("printed", "n", "word", "sign", "letter").distinct())
    rivals = candidates.groupBy("printed").agg(F.min("word").alias("least"), F.max("word").alias("most")).where("least = most").select("printed")
    pairs = candidates.join(rivals, "printed").groupBy("sign", "letter", "word").agg(F.sum("n").alias("n")).groupBy("sign", "letter").agg(F.count("*").alias("words"), F.sum("n").alias("n"))
    pairs = staged(pairs)  # as many rows as there are confusions of signs
    read = pairs.groupBy("letter").agg(F.sum("n").alias("read"))
    held = pairs.join(read, "letter").where((F.col("words") >= WORDS) & (F.col("n") >= F.col("read") * SHARE)).select("sign", "letter")
    fits = candidates.join(narrow(staged(held)), ["sign", "letter"], "left_semi").groupBy("printed").agg(F.min("word").alias("word"), F.max("word").alias("most"))
    return fits.where("word = most").select("printed", "word")


def cases(pages: DataFrame, documents: DataFrame, labels: DataFrame, dictionary: DataFrame, common_words: DataFrame) -> DataFrame:
    """``page_id, line_no, kind, printed, word`` of everything to repair."""
    model, _ = quality.fitted(pages, labels, dictionary, common_words)
    seen = staged(observed(pages, lookalikes.forms(pages), model))
    plain = seen.where("kind in ('page_number', 'hyphen')").select("page_id", "line_no", "kind", "printed", "word")

    edges = seen.where("kind = 'edge'").select("doc_id", "a", "b", "page_number", "page_id", "line_no")
    raw = pages.where("stage = 'ocr'").select("doc_id", "page_id").distinct().groupBy("doc_id").agg(F.count("*").alias("raw"))
    carried = edges.select("doc_id", "a", "b", "page_id", "page_number").distinct().groupBy("doc_id", "a", "b").agg(F.count("*").alias("on"), F.min("page_number").alias("least"), F.max("page_number").alias("most"))
    running = staged(carried.where("least < most").join(raw, "doc_id").where(F.col("on") * RAW_SHARE >= F.col("raw")).select("doc_id", "a", "b"))
    headers = edges.join(narrow(running), ["doc_id", "a", "b"], "left_semi").select("page_id", "line_no")
    headers = headers.join(notices.found(pages, documents), ["page_id", "line_no"], "left_anti")
    headers = headers.select("page_id", "line_no", F.lit("header").alias("kind"), F.lit("").alias("printed"), F.lit("").alias("word"))

    unknown = seen.where("kind = 'unknown'").select("page_id", "line_no", "printed")
    right = staged(corrections(unknown.groupBy("printed").agg(F.count("*").alias("n")), dictionary))
    misread = unknown.join(narrow(right), "printed").select("page_id", "line_no", F.lit("misread").alias("kind"), "printed", "word")
    return plain.unionByName(headers).unionByName(misread).distinct()


def found(pages: DataFrame, documents: DataFrame, labels: DataFrame, dictionary: DataFrame, common_words: DataFrame) -> DataFrame:
    return cases(pages, documents, labels, dictionary, common_words).select("page_id", "line_no", "kind", "word").distinct()


def _cased(printed: str, word: str) -> str:
    return word.upper() if len(printed) > 1 and printed.isupper() else word[:1].upper() + word[1:] if printed[:1].isupper() else word


def repaired_text(text: str | None, own: lookalikes.Forms, rows: list[tuple]) -> str | None:
    """Paragraphs of a raw page: edge lines out, words whole and right, lines joined up to the next blank one."""
    if text is None:
        return None
    out = {i for i, kind, _, _ in rows if kind in ("header", "page_number")}
    whole = {i: word for i, kind, _, word in rows if kind == "hyphen"}
    right: dict[int, dict[str, str]] = {}
    for i, kind, printed, word in rows:
        if kind == "misread":
            right.setdefault(i, {})[printed] = word
    paragraphs, current, glue = [], [], False
    for i, line in enumerate(own.line(text).split("\n")):
        if i in out:
            continue
        words = line.split()
        if not words:
            if current:
                paragraphs.append(" ".join(current))
            current, glue = [], False
            continue
        for j, w in enumerate(words):
            core = w.strip(quality._EDGE)
            if (to := right.get(i, {}).get(quality._MARKS.sub("", core.lower()))) and core:
                w = w.replace(core, _cased(core, to))
            if glue and current:
                head, tail = current.pop(), w
                core = tail.strip(quality._EDGE)
                bare = head.rstrip(HYPHENS)
                w = (head if f"{bare.strip(quality._EDGE)}-{core}".lower() == glue else bare) + tail
                glue = False
            current.append(w)
        glue = whole.get(i, False)
    if current:
        paragraphs.append(" ".join(current))
    return "\n".join(paragraphs)


def repaired(pages: DataFrame, documents: DataFrame, labels: DataFrame, dictionary: DataFrame, common_words: DataFrame) -> DataFrame:
    """``page_id, text, n_repairs``: every raw page once, as continuous paragraphs; junk pages keep their lines' words."""
    own = pages.sparkSession.sparkContext.broadcast(lookalikes.forms(pages))
    by_page = cases(pages, documents, labels, dictionary, common_words).groupBy("page_id").agg(F.collect_list(F.struct("line_no", "kind", "printed", "word")).alias("rows"))  # those of one page
    raw = once_per(pages.where("stage = 'ocr'").select("page_id", "text"), "page_id").join(by_page, "page_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = [], []
            for text, rows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows = [(r["line_no"], r["kind"], r["printed"], r["word"]) for r in rows or []]
                texts.append(repaired_text(text, own.value, rows))
                n.append(len(rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int32())], names=["page_id", "text", "n_repairs"])

    return raw.select("page_id", "text", "rows").mapInArrow(run, "page_id long, text string, n_repairs int")

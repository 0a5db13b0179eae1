"""Full-text search: postings, ranked boolean, phrase, prefix and proximity queries, snippets.

A query reads the postings of its own terms only and decides each page by one aggregation over
them; ranking is by BM25 (k1 1.2, b 0.75), the best pages by a bounded sort.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.workspace import narrow, staged

_TOKEN = r"[\p{L}\p{N}\p{Co}]+"
_MARKS = r"[\x{300}-\x{331}]+"
#: Tokens of a snippet.
SNIPPET = 30


@lru_cache(1)
def folding() -> tuple[str, str]:
    """Latin letters with diacritics, and the same without."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]]
    pairs = [(a, b) for a, b in pairs if a != b and a.islower() and b.isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def terms(t: Column) -> Column:
    """Terms of a text in order: lower case, without diacritics; everything but letters and digits separates."""
    return F.regexp_extract_all(F.translate(F.regexp_replace(F.lower(F.coalesce(t, F.lit(""))), _MARKS, ""), *folding()), F.lit(f"({_TOKEN})"), 1)


def fold(word: str) -> str:
    return re.sub("[̀-̱]", "", word.lower()).translate(str.maketrans(*folding()))


def page_lengths(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return pages.select(key, F.size(terms(F.col("text"))).alias("len"))


def postings(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``term, key, tf, positions``"""
    rows = pages.select(key, F.posexplode(terms(F.col("text"))).alias("pos", "term"))
    return rows.groupBy("term", key).agg(F.count("*").alias("tf"), F.sort_array(F.collect_list("pos")).alias("positions"))  # of one page


def updated(index: DataFrame, changed: DataFrame, removed: DataFrame, key: str = "page_id") -> DataFrame:
    """Postings after pages were changed (``key, text``) or removed (``key``)."""
    gone = changed.select(key).unionAll(removed.select(key)).distinct()
    return index.join(gone, key, "left_anti").unionByName(postings(changed, key))


class Query:
    """A parsed query: its phrases and a condition over their positions.

    ``a b`` and ``a AND b``, ``a OR b``, ``a NOT b``, ``"a b"``, ``a + b``, ``pre*``, ``^a``, ``NEAR(a b, n)``, brackets, ``text : ...``."""

    _SPLIT = re.compile(r'\s*(?:("(?:[^"]|"")*")|([()^*+,:{}-])|([^\s()"^*+,:{}-]+))')

    def __init__(self, text: str):
        self.phrases: list[tuple[tuple[str, ...], bool, bool]] = []  # terms, last is a prefix, first of the page
        self._parts, at = [], 0
        text = text.strip()
        while at < len(text):
            m = self._SPLIT.match(text, at)
            self._parts.append(("phrase", m[1][1:-1].replace('""', '"')) if m[1] else ("sign", m[2]) if m[2] else ("word", m[3]))
            at = m.end()
        self._i = 0
        self.condition = self._or()
        if self._i < len(self._parts):
            raise ValueError(f"unexpected {self._parts[self._i][1]!r} in the query")

    def _next(self) -> tuple[str, str] | None:
        return self._parts[self._i] if self._i < len(self._parts) else None

    def _take(self, kind: str, value: str) -> bool:
        if self._next() == (kind, value):
            self._i += 1
            return True
        return False

    def _or(self):
        left = self._and()
        while self._take("word", "OR"):
            left = ("or", left, self._and())
        return left

    def _and(self):
        left = self._not()
        while True:
            if self._take("word", "AND"):
                left = ("and", left, self._not())
            elif (n := self._next()) and n not in (("word", "OR"), ("sign", ")")) and n != ("word", "NOT"):
                left = ("and", left, self._not())
            else:
                return left

    def _not(self):
        left = self._one()
        while self._take("word", "NOT"):
            left = ("and", left, ("not", self._one()))
        return left

    def _one(self):
        if self._take("sign", "("):
            inner = self._or()
            if not self._take("sign", ")"):
                raise ValueError("a bracket isn't closed")
            return inner
        kind, value = self._next() or ("end", "")
        if kind == "word" and value == "NEAR" and self._i + 1 < len(self._parts) and self._parts[self._i + 1] == ("sign", "("):
            self._i += 2
            own, distance = [], 10
            while not self._take("sign", ")"):
                if self._take("sign", ","):
                    distance = int(self._parts[self._i][1])
                    self._i += 1
                elif self._next() is None:
                    raise ValueError("a bracket isn't closed")
                else:
                    own.append(self._phrase())
            return ("near", own, distance)
        if kind == "word" and self._i + 1 < len(self._parts) and self._parts[self._i + 1] == ("sign", ":"):
            if value != "text":
                raise ValueError(f"no such column: {value}")
            self._i += 2
            return self._one()
        return ("phrase", self._phrase())

    def _phrase(self) -> int:
        first = self._take("sign", "^")
        own: list[str] = []
        while True:
            kind, value = self._next() or ("end", "")
            if kind not in ("word", "phrase"):
                raise ValueError("a term is missing in the query")
            self._i += 1
            own += re.findall(r"[^\W_]+", fold(value))
            if not self._take("sign", "+"):
                break
        prefix = self._take("sign", "*")
        self.phrases.append((tuple(own), prefix, first))
        return len(self.phrases) - 1

    def wanted(self, term: Column) -> Column:
        """Terms that the query reads."""
        whole = {t for own, prefix, _ in self.phrases for t in (own[:-1] if prefix else own)}
        out = term.isin(*whole) if whole else F.lit(False)
        for own, prefix, _ in self.phrases:
            if prefix and own:
                out = out | term.startswith(own[-1])
        return out

    def hits(self, i: int, entries: Column) -> Column:
        """Places of a phrase on a page, by ``entries`` (term, positions)."""
        own, prefix, first = self.phrases[i]
        if not own:
            return F.array().cast("array<int>")

        def places(k: int) -> Column:
            match = (lambda e: e.term.startswith(own[k])) if prefix and k == len(own) - 1 else (lambda e: e.term == own[k])
            return F.flatten(F.transform(F.filter(entries, match), lambda e: e.positions))

        out = places(0)
        for k in range(1, len(own)):
            out = self._followed(out, places(k), k)
        return F.filter(out, lambda p: p == 0) if first else out

    @staticmethod
    def _followed(start: Column, places: Column, k: int) -> Column:
        """Those of the starting places that have one of ``places`` so many terms on."""
        return F.filter(start, lambda p: F.array_contains(places, p + k))

    def holds(self, node, at: list[Column]) -> Column:
        kind = node[0]
        if kind == "phrase":
            return F.size(at[node[1]]) > 0
        if kind == "not":
            return ~self.holds(node[1], at)
        if kind == "near":
            own, n = node[1], node[2]
            size = [len(self.phrases[i][0]) for i in own]

            def close(p: Column, k: int) -> Column:
                return F.exists(at[own[k]], lambda q: F.when(q > p, q - p - size[0]).otherwise(p - q - size[k]) <= n)

            return F.exists(at[own[0]], lambda p: reduce(lambda x, k: x & close(p, k), range(1, len(own)), F.lit(True)))
        both = [self.holds(x, at) for x in node[1:]]
        return both[0] & both[1] if kind == "and" else both[0] | both[1]


def matches(index: DataFrame, query: Query, key: str = "page_id") -> DataFrame:
    """``key, at``: pages that the query matches, with the places of each of its phrases."""
    own = index.where(query.wanted(F.col("term"))).groupBy(key).agg(F.collect_list(F.struct("term", "positions")).alias("entries"))  # terms of the query on one page
    own = own.select(key, F.array(*(query.hits(i, F.col("entries")) for i in range(len(query.phrases)))).alias("at"))
    return own.withColumn("matched", query.holds(query.condition, [F.col("at")[i] for i in range(len(query.phrases))]))


def ranked(index: DataFrame, lengths: DataFrame, query: str, key: str = "page_id") -> DataFrame:
    """``key, at, rank``: matching pages, the best with the least rank."""
    q = Query(query)
    own = staged(matches(index, q, key))
    n = len(q.phrases)
    total = lengths.agg(F.count("*").alias("pages"), F.avg("len").alias("mean"))
    df = own.agg(*(F.count_if(F.size(F.col("at")[i]) > 0).alias(f"df{i}") for i in range(n)))
    rows = own.where("matched").join(lengths, key).join(F.broadcast(total.join(df)))  # one row
    score = F.lit(0.0)
    for i in range(n):
        f = F.size(F.col("at")[i]).cast("double")
        idf = F.log((F.col("pages") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        idf = F.when(idf <= 0, 1e-6).otherwise(idf)
        score = score + idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * F.col("len") / F.col("mean")))
    return rows.select(key, "at", (-score).alias("rank"))


def snippet(text: Column, hits: Column, size: int = SNIPPET) -> Column:
    """``size`` tokens from the first hit on, or from before it where the text ends sooner; hits between >>> and <<<, ... where text is left out."""
    raw = F.regexp_extract_all(text, F.lit(r"([^\p{L}\p{N}\p{Co}]*[\p{L}\p{N}\p{Co}\x{300}-\x{331}]+)"), 1)
    n = F.size(raw)
    begin = F.greatest(F.lit(0), F.least(F.array_min(hits), n - size))
    shown = F.transform(F.slice(raw, begin + 1, F.lit(size)), lambda x, i: F.when(F.array_contains(hits, begin + i), F.regexp_replace(x, r"([\p{L}\p{N}\p{Co}\x{300}-\x{331}]+)$", ">>>$1<<<")).otherwise(x))
    body = F.regexp_replace(F.array_join(shown, ""), r"^\s+", "")
    return F.concat(F.when(begin > 0, "...").otherwise(""), body, F.when(begin + size < n, "...").otherwise(""))


def search(pages: DataFrame, documents: DataFrame, query: str, limit: int = 20, index: DataFrame | None = None, lengths: DataFrame | None = None) -> DataFrame:
    """The best pages of stored documents: ``filename, source, year, confidence, page_number, snippet, rank``. ``documents`` has a ``doc_id`` as pages have it."""
    q = Query(query)
    index = postings(pages) if index is None else index
    lengths = page_lengths(pages) if lengths is None else lengths
    hits = ranked(index, lengths, query).join(pages.select("page_id", "doc_id", "page_number"), "page_id").join(documents, "doc_id")
    best = narrow(staged(hits.orderBy("rank", "page_id").limit(limit)))
    found = F.array_sort(F.array_distinct(F.flatten(F.transform("at", lambda x, i: F.flatten(F.transform(x, lambda p: F.sequence(p, p + F.element_at(F.array(*(F.lit(max(1, len(w))) for w, _, _ in q.phrases)), i + 1) - 1)))))))
    rows = best.join(pages.select("page_id", "text"), "page_id").select("filename", "source", "year", "confidence", "page_number", snippet(F.col("text"), found).alias("snippet"), "rank", "page_id")
    return rows.orderBy("rank", "page_id")

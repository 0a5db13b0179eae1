"""Cleaning of document texts: repeated headers, continuation marks, punctuation, parentheses, issue headers.

A document is the pages of one ``doc_id``; each ``page_id`` is a page, in the order of page
number and page id. Repeated headers are few per document by their definition, so that all
line rules of a page are array expressions over one row: only the headers are shuffled, a
document with a third of all pages is no hot group.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import SPACE, replace_all, stem, strip
from quire.workspace import narrow, staged

MARK, END_MARK = "[כותרת]", "[/כותרת]"
# Phrases that say that a text goes on elsewhere.
PHRASES = ("המשך בעמוד הבא", "המשך בעמוד", "המשך פנינים יקרים", "המשך בעמ'", "המשך מעמ' קודם", "המשך מעמוד קודם", "המשך מעמ'")


@dataclass(frozen=True)
class Cleaning:
    phrases: tuple[str, ...] = PHRASES
    headers: tuple[str, ...] = ()
    scan_lines: int = 3
    page_ratio: float = 0.5
    similar: float = 0.85
    corrections: tuple[tuple[str, str], ...] = ()
    template: str = f"{'═' * 30}\n         גליון מס' {{issue_number}}\n         {{issue_date}}\n{'═' * 30}\n"
    #: Names that aren't dates where a file name is read.
    publications: tuple[str, ...] = ()


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def repeating_headers(pages: DataFrame, rules: Cleaning = Cleaning()) -> DataFrame:
    """``doc_id, line, n``: lines at the top of at least so many pages of a document of three pages or more. A line twice on one page counts twice."""
    total = pages.groupBy("doc_id").agg(F.count("*").alias("pages")).where("pages >= 3")
    top = F.slice(F.filter(F.transform(_lines(F.col("text")), strip), lambda x: x != ""), 1, rules.scan_lines)
    lines = pages.where("text is not null").select("doc_id", F.explode(F.filter(top, lambda x: F.length(x) > 3)).alias("line"))
    counts = lines.groupBy("doc_id", "line").agg(F.count("*").alias("n")).where("n >= 2")
    least = F.greatest(F.lit(2), (F.col("pages") * F.lit(rules.page_ratio)).cast("int"))
    return counts.join(total, "doc_id").where(F.col("n") >= least).select("doc_id", "line", "n")


def header_text(line: Column) -> Column:
    return strip(replace_all(line, [(MARK, ""), (END_MARK, "")]))


def marked_headers(pages: DataFrame) -> DataFrame:
    """``doc_id, page_id, line_no, header, first``: marked header lines; ``first`` says whether the document has it there for the first time."""
    rows = pages.where(F.col("text").contains(MARK)).select("doc_id", "page_number", "page_id", F.posexplode(_lines(F.col("text"))).alias("line_no", "line")).where(F.col("line").contains(MARK))
    rows = rows.select("doc_id", "page_number", "page_id", "line_no", header_text(F.col("line")).alias("header"))
    first = rows.groupBy("doc_id", "header").agg(F.min(F.struct("page_number", "page_id", "line_no")).alias("at"))
    same = (F.col("at.page_id") == F.col("page_id")) & (F.col("at.line_no") == F.col("line_no"))
    return rows.join(first, ["doc_id", "header"]).select("doc_id", "page_id", "line_no", "header", same.alias("first"))


def is_interstitial(line: Column, rules: Cleaning = Cleaning()) -> Column:
    """Whether a line says that the text goes on elsewhere. Only lines with the first word of a phrase are looked at closely."""
    first = {"המשך", *(p.split()[0].rstrip("'׳\"״") for p in rules.phrases if p.split())}
    plain = F.regexp_replace(line, f"{SPACE}*['׳\"״]{SPACE}*", "'")
    hit = line.rlike(f"המשך{SPACE}+.+{SPACE}+בעמוד|המשך{SPACE}+מעמ|המשך{SPACE}+יבוא") | plain.rlike(f"המשך{SPACE}+בעמ")
    for p in rules.phrases:
        hit = hit | line.contains(p) | plain.contains(p)
    return F.when(reduce(lambda a, b: a | b, (line.contains(w) for w in sorted(first))), hit).otherwise(False)


def similar(a: Column, b: Column, least: float = 0.85) -> Column:
    """Whether so many places of the longer text hold the same character in both; lengths too different are never similar."""
    n, m = F.length(a), F.length(b)
    longest, shortest = F.greatest(n, m), F.least(n, m)
    same = F.size(F.filter(F.sequence(F.lit(1), shortest), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))))
    close = F.try_divide((longest - shortest).cast("double"), longest.cast("double")) <= F.lit(1 - least)
    return (shortest > 0) & F.when(close, F.try_divide(same.cast("double"), longest.cast("double")) >= F.lit(least)).otherwise(False)


def is_header(line: Column, headers: Column, least: float = 0.85) -> Column:
    """Whether a line holds, is part of, or is similar to one of the headers."""
    return F.exists(headers, lambda h: line.contains(h) | h.contains(line) | similar(line, h, least))


def collapse_punctuation(t: Column) -> Column:
    return F.regexp_replace(t, r"([,.;:!?\-])\1+", "$1")


def fix_parentheses(t: Column) -> Column:
    """Swap all parentheses of a text where they are balanced in number but one closes before any opens."""
    signs = F.regexp_replace(t, r"[^()]+", "")
    n = F.length(signs)
    balanced = (n >= 2) & (F.length(F.replace(signs, F.lit("("), F.lit(""))) * 2 == n)
    run = F.aggregate(
        F.split(signs, ""),
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("low")),
        lambda s, c: F.struct((s.now + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("now"), F.least(s.low, s.now + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("low")),
    )
    return F.when(balanced & F.when(balanced, run.low < 0).otherwise(False), F.translate(t, "()", ")(")).otherwise(t)


def issue_info(filename: Column, rules: Cleaning = Cleaning()) -> Column:
    """``issue_number`` and ``issue_date`` of a file name, empty where there is none."""
    name = stem(filename)
    number = F.regexp_extract(name, r"\p{Nd}+", 0)
    year = F.regexp_extract(name, "[תש][שׁ][פצ][\"״׳']?[א-ת]", 0)
    parts = F.filter(F.split(name, f"[_\\-{SPACE[1:-1]}]+"), lambda x: (x != "") & ~x.rlike(r"^\p{Nd}+$") & ~x.isin(*rules.publications) if rules.publications else (x != "") & ~x.rlike(r"^\p{Nd}+$"))
    return F.struct(number.alias("issue_number"), F.when(year != "", year).otherwise(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))).alias("issue_date"))


def issue_header(info: Column, rules: Cleaning = Cleaning()) -> Column:
    return F.replace(F.replace(F.lit(rules.template), F.lit("{issue_number}"), info.issue_number), F.lit("{issue_date}"), info.issue_date)


def strip_markers(t: Column) -> Column:
    return replace_all(t, [(MARK + " ", ""), (" " + END_MARK, ""), (MARK, ""), (END_MARK, "")])


def correct(t: Column, rules: Cleaning = Cleaning()) -> Column:
    return replace_all(t, list(rules.corrections))


def clean_pages(pages: DataFrame, rules: Cleaning = Cleaning()) -> DataFrame:
    """``page_id, doc_id, filename, page_number, text``: every page after all steps, up to the marks and corrections."""
    found = repeating_headers(pages, rules).groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("headers"))  # at most 2 * scan_lines of a document
    dropped = marked_headers(pages).where("not first").groupBy("page_id").agg(F.collect_set("line_no").alias("repeated"))
    first = pages.groupBy("doc_id").agg(F.min(F.struct("page_number", "page_id")).alias("at")).select(F.col("at.page_id").alias("page_id"), F.lit(True).alias("first"))
    rows = pages.select("page_id", "doc_id", "filename", "page_number", "text").join(narrow(staged(found)), "doc_id", "left").join(narrow(staged(dropped)), "page_id", "left").join(narrow(staged(first)), "page_id", "left")
    headers = F.concat(F.coalesce("headers", F.array().cast("array<string>")), F.array(*map(F.lit, rules.headers)).cast("array<string>"))
    repeated = F.coalesce("repeated", F.array().cast("array<int>"))

    def keep(x: Column, i: Column) -> Column:
        return F.when(x.bare == "", True).when(x.bare.contains(MARK), ~F.array_contains("repeated", i)).otherwise(~is_interstitial(x.bare, rules) & ~is_header(x.bare, F.col("headers"), rules.similar))

    rows = rows.withColumns({"headers": headers, "repeated": repeated, "lines": F.transform(_lines(F.col("text")), lambda x: F.struct(x.alias("line"), strip(x).alias("bare")))})
    kept = F.transform(F.filter("lines", keep), lambda x: x.line)
    # one step a column: an expression that a later one names several times is computed once
    rows = rows.withColumn("text", F.when(F.coalesce("text", F.lit("")) == "", F.col("text")).otherwise(strip(F.array_join(kept, "\n"))))
    rows = rows.withColumn("text", collapse_punctuation(F.col("text")))
    rows = rows.withColumn("text", fix_parentheses(F.col("text"))).withColumn("info", issue_info(F.col("filename"), rules))
    head = issue_header(F.col("info"), rules)
    has = F.coalesce("first", F.lit(False)) & (F.lit(rules.template) != "") & (F.col("info.issue_number") != "")
    text = F.when(has, F.when(F.coalesce("text", F.lit("")) != "", F.concat(head, F.lit("\n\n"), "text")).otherwise(head)).otherwise(F.col("text"))
    return rows.withColumn("text", text).withColumn("text", correct(strip_markers(F.col("text")), rules)).select("page_id", "doc_id", "filename", "page_number", "text")

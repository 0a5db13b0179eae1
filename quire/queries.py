"""Queries over the reference's own operators, each over its whole tables, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import SPACE, strip
from quire.operators import cleaning, layout, quality, report, search, store
from quire.operators import dictionary as words
from quire.sources import images, ocr
from quire.workspace import once_per, table

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}

_PAGE = ["page_id", "doc_id", "filename", "page_number", "text", "confidence"]
P = f"(SELECT DISTINCT {', '.join(_PAGE)} FROM pages)"
NL = "chr(10)"
H = r"[\x{590}-\x{5ff}]"
NIKUD = r"[\x{5b0}-\x{5bd}\x{5bf}\x{5c1}\x{5c2}]"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def e6(c) -> F.Column:
    """Millionths as whole numbers: sums of doubles depend on their order in the last digits. Halves, which that would tip, aren't where the steps are."""
    return F.floor(F.col(c) * 1_000_000 + 0.5137).cast("long")


def sql_e6(x: str) -> str:
    return f"CAST(floor(({x}) * 1000000 + 0.5137::DOUBLE) AS BIGINT)"


def pages(spark: SparkSession, d: str) -> DataFrame:
    """Every page once."""
    return once_per(table(spark, d, "pages").select(*_PAGE), "page_id")


def stored(spark: SparkSession, d: str) -> DataFrame:
    """Pages of issues that have a row in documents; a volume without one is no document and is never gathered."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"))
    return pages(spark, d).join(docs, "doc_id", "left_semi")


STORED = f"(SELECT p.* FROM {P} p SEMI JOIN (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents) d ON p.doc_id = d.doc_id)"


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(f: Run) -> Run:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


# --- quality of texts

_W = "regexp_extract_all(t, '" + H + "+')"
_REPEATED = "|".join(rf"\x{{{c:x}}}{{3,}}" for c in range(0x590, 0x600))
_BLANK = f"{sql_strip('t')} = ''"
_CHECKS = f"""
WITH t AS (SELECT id, coalesce(text, '') AS t, greatest(coalesce(num_pages, 1), 1) AS n FROM texts),
m AS (SELECT id, t, n, length(regexp_replace(t, '[^\\x{{590}}-\\x{{5ff}}]', '', 'g')) AS hebrew, length(regexp_replace(t, '\\P{{L}}', '', 'g')) AS alpha,
  length(regexp_replace(t, '[^{quality.WEIRD}]', '', 'g')) AS weird, length({sql_strip('t')}) AS total,
  (length(t) - length(replace(t, '  ', ''))) // 2 AS double_spaces, (length(t) - length(replace(t, '   ', ''))) // 3 AS triple_spaces,
  len(list_filter(string_split(t, {NL}), lambda x: length(x) > 30 AND NOT contains(x, ' '))) AS merged_lines,
  CAST(coalesce(list_sum(list_transform({_W}, lambda v: length(regexp_replace(v[1:length(v) - 1], '[^{quality.FINAL}]', '', 'g')))), 0) AS BIGINT) AS final_in_middle,
  len(list_filter({_W}, lambda v: length(v) > 1 AND contains('{quality.REGULAR}', right(v, 1)))) AS regular_at_end,
  len(regexp_extract_all(t, '{NIKUD}')) AS nikud_count, len(regexp_extract_all(t, '{NIKUD}{{2,}}')) AS double_nikud, len(regexp_extract_all(t, '[^\\x{{590}}-\\x{{5ff}}]{NIKUD}')) AS nikud_on_non_hebrew,
  len(list_filter({_W}, lambda v: length(v) = 1 AND NOT contains('{quality.SINGLE}', v))) AS single_char_errors, len(regexp_extract_all(t, '{_REPEATED}')) AS repeated_chars FROM t),
c AS (SELECT *, {_BLANK} AS blank, CASE WHEN {_BLANK} OR alpha = 0 THEN 0.0::DOUBLE ELSE hebrew::DOUBLE / alpha END AS ratio, double_spaces + triple_spaces * 2 + merged_lines * 5 AS error_score,
  total::DOUBLE / n AS avg_per_page, final_in_middle + regular_at_end AS errors FROM m),
k AS (SELECT *, NOT blank AND alpha > 0 AND ratio >= 0.85::DOUBLE AS hebrew_passed, weird <= 10 AS weird_passed, avg_per_page BETWEEN 500 AND 5000 AS length_passed, error_score < 50 AS spacing_passed,
  errors < 10 AS final_passed, double_nikud < 5 AND nikud_on_non_hebrew < 3 AS nikud_passed, single_char_errors < 10 AND repeated_chars < 5 AS grammar_passed FROM c),
s AS (SELECT *, CAST(greatest(0, least(100, 100 - CASE WHEN hebrew_passed THEN 0 ELSE CAST(trunc((0.85::DOUBLE - round(ratio, 4)) * 100) AS BIGINT) END - CASE WHEN weird_passed THEN 0 ELSE least(15, weird) END
  - CASE WHEN length_passed THEN 0 ELSE 10 END - CASE WHEN spacing_passed THEN 0 ELSE least(10, error_score // 5) END - CASE WHEN final_passed THEN 0 ELSE least(10, errors) END
  - CASE WHEN nikud_passed THEN 0 ELSE 5 END - CASE WHEN grammar_passed THEN 0 ELSE 5 END)) AS INTEGER) AS score FROM k),
r AS (SELECT *, CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 75 THEN 'good' WHEN score >= 60 THEN 'needs_review' ELSE 'poor_quality' END AS recommendation FROM s)
"""


def _checked(spark: SparkSession, d: str) -> DataFrame:
    return quality.checked(table(spark, d, "texts"))


@query("q1_hebrew_ratio", _CHECKS + """SELECT id, ratio, CASE WHEN NOT blank AND alpha > 0 THEN hebrew END AS hebrew_chars, CASE WHEN NOT blank AND alpha > 0 THEN alpha END AS total_alpha, hebrew_passed AS passed,
  CASE WHEN blank THEN 'empty text' WHEN alpha = 0 THEN 'no alphabetic chars' END AS detail FROM r""")  # fmt: skip
def q1(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("id", "hebrew_ratio.*")


@query("q2_weird_chars", _CHECKS + f"""SELECT id, weird AS "count", weird_passed AS passed, array_to_string(list_transform(list_filter(CAST(range(1, length(t) + 1) AS BIGINT[]), lambda i: contains('{quality.WEIRD}', substring(t, i, 1)))[1:20],
  lambda i: substring(t, i, 1) || (i - 1)), ' ') AS found FROM r""")  # fmt: skip
def q2(spark: SparkSession, d: str) -> DataFrame:
    found = F.array_join(F.transform("weird_chars.found", lambda x: F.concat(x.char, x.position)), " ")
    return _checked(spark, d).select("id", "weird_chars.count", "weird_chars.passed", found.alias("found"))


@query("q3_text_length", _CHECKS + "SELECT id, total AS total_chars, avg_per_page, length_passed AS passed FROM r")
def q3(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("id", "text_length.total_chars", "text_length.avg_per_page", "text_length.passed")


@query("q4_spacing", _CHECKS + "SELECT id, double_spaces, triple_spaces, merged_lines, error_score, spacing_passed AS passed FROM r")
def q4(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("id", "spacing.*")


@query("q5_final_letters", _CHECKS + "SELECT id, final_in_middle, regular_at_end, errors, final_passed AS passed FROM r")
def q5(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("id", *(f"final_letters.{c}" for c in ("final_in_middle", "regular_at_end", "errors", "passed")))


@query("q5_final_letter_details")
def q5_details(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("id", F.posexplode("final_letters.details").alias("n", "x")).select("id", "n", "x.*")


@query("q6_nikud", _CHECKS + "SELECT id, nikud_count, double_nikud, nikud_on_non_hebrew, nikud_passed AS passed FROM r")
def q6(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("id", "nikud.*")


@query("q7_grammar", _CHECKS + "SELECT id, single_char_errors, repeated_chars, grammar_passed AS passed FROM r")
def q7(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d).select("id", "grammar.*")


@query("q8_score", _CHECKS + "SELECT id, score FROM r")
def q8(spark: SparkSession, d: str) -> DataFrame:
    return quality.scored(table(spark, d, "texts")).select("id", "score")


@query("q9_recommendation", _CHECKS + "SELECT id, recommendation FROM r")
def q9(spark: SparkSession, d: str) -> DataFrame:
    return quality.scored(table(spark, d, "texts")).select("id", "recommendation")


@query("q10_quality_report", _CHECKS + "SELECT id, num_pages, hebrew_passed, weird_passed, length_passed, spacing_passed, final_passed, nikud_passed, grammar_passed, score, recommendation FROM r JOIN (SELECT id, num_pages FROM texts) USING (id)")
def q10(spark: SparkSession, d: str) -> DataFrame:
    r = quality.report(table(spark, d, "texts")).withColumn("a", F.col("quality_report.level1")).withColumn("b", F.col("quality_report.level2"))
    passed = {"hebrew": "a.hebrew_ratio", "weird": "a.weird_chars", "length": "a.text_length", "spacing": "a.spacing", "final": "b.final_letters", "nikud": "b.nikud", "grammar": "b.grammar"}
    return r.select("id", "num_pages", *(F.col(f"{c}.passed").alias(f"{k}_passed") for k, c in passed.items()), "quality_report.score", "quality_report.recommendation")


# --- results and reports

_RUNS = "(SELECT DISTINCT * FROM results)"
_OK = f"(SELECT * FROM {_RUNS} WHERE error IS NULL)"
_LATEST = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filename ORDER BY run_at DESC NULLS LAST, source DESC NULLS LAST, confidence DESC NULLS LAST, quality_score DESC NULLS LAST, recommendation DESC NULLS LAST) AS k
  FROM {_OK}) WHERE k = 1)"""


def _runs(spark: SparkSession, d: str) -> DataFrame:
    return report.runs(table(spark, d, "results"))


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return store.latest_runs(_runs(spark, d))


@query("a1_document_confidence", f"SELECT doc_id, count(*) AS pages, {sql_e6('coalesce(avg(nullif(confidence, 0)), 0)')} AS confidence_e6 FROM {P} GROUP BY doc_id")
def a1(spark: SparkSession, d: str) -> DataFrame:
    return report.document_confidence(pages(spark, d)).select("doc_id", "pages", e6("confidence").alias("confidence_e6"))


@query("a2_document_text", f"SELECT doc_id, md5(coalesce(string_agg(text, '{report.PAGE_BREAK.replace(chr(10), chr(39) + ' || chr(10) || ' + chr(39))}' ORDER BY page_number, page_id) FILTER (text <> ''), '')) AS text_md5 FROM {STORED} GROUP BY doc_id".replace("string_agg(text, '", "string_agg(text, ('").replace("' ORDER BY", "') ORDER BY"))
def a2(spark: SparkSession, d: str) -> DataFrame:
    return report.build_results(stored(spark, d)).select("doc_id", F.md5("text").alias("text_md5"))


@query("a3_pages_data", f"SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_number NULLS FIRST, page_id) AS INTEGER) AS page_number, md5(coalesce(text, '')) AS text_md5, coalesce(confidence, 0) AS confidence FROM {STORED}")
def a3(spark: SparkSession, d: str) -> DataFrame:
    return report.build_results(stored(spark, d)).select("doc_id", F.inline("pages_data")).select("doc_id", F.col("page_number").cast("int").alias("page_number"), F.md5("text").alias("text_md5"), "confidence")


@query("s14_results", f"""SELECT doc_id, min(filename) AS filename, count(*) AS pages, {sql_e6('coalesce(avg(nullif(confidence, 0)), 0)')} AS confidence_e6,
  CAST(coalesce(sum(length(text)) FILTER (text <> '') + {len(report.PAGE_BREAK)} * (count(*) FILTER (text <> '') - 1), 0) AS BIGINT) AS chars FROM {STORED} GROUP BY doc_id""")  # fmt: skip
def s14(spark: SparkSession, d: str) -> DataFrame:
    return report.build_results(stored(spark, d)).select("doc_id", "filename", "pages", e6("confidence").alias("confidence_e6"), F.length("text").cast("long").alias("chars"))


@query("a4_aggregate", f"""SELECT count(*) AS total, {sql_e6('avg(coalesce(confidence, 0))')} AS avg_confidence_e6, {sql_e6('avg(coalesce(quality_score, 0))')} AS avg_score_e6, count(*) FILTER (coalesce(confidence, 0) >= 0.9::DOUBLE) AS excellent,
  count(*) FILTER (confidence >= 0.8::DOUBLE AND confidence < 0.9::DOUBLE) AS good, count(*) FILTER (coalesce(confidence, 0) < 0.8::DOUBLE) AS problematic FROM {_OK}""")  # fmt: skip
def a4(spark: SparkSession, d: str) -> DataFrame:
    return report.aggregate(report.successful(_runs(spark, d))).select("total", e6("avg_confidence").alias("avg_confidence_e6"), e6("avg_score").alias("avg_score_e6"), "excellent", "good", "problematic")


@query("a4_recommendations", f"SELECT coalesce(recommendation, 'unknown') AS recommendation, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM {_OK}) AS share FROM {_OK} GROUP BY 1")
def a4_recommendations(spark: SparkSession, d: str) -> DataFrame:
    return report.by_recommendation(report.successful(_runs(spark, d)))


@query("a4_needing_attention", f"SELECT filename, source, confidence, quality_score, recommendation FROM {_OK} WHERE quality_score < 75")
def a4_needing_attention(spark: SparkSession, d: str) -> DataFrame:
    return report.needing_attention(report.successful(_runs(spark, d)))


@query("a4_report_text")
def a4_report(spark: SparkSession, d: str) -> DataFrame:
    return report.aggregate_report(report.successful(_runs(spark, d)))


@query("a5_file_reports")
def a5(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "texts").select(F.format_string("%d.pdf", "id").alias("filename"), "text", "num_pages", F.coalesce("num_pages", F.lit(1)).alias("pages"), F.lit(0.9).alias("confidence"))
    return report.file_reports(quality.scored(texts))


@query("a6_summary", f"""SELECT count(*) FILTER (error IS NULL) AS succeeded, count(*) FILTER (error IS NOT NULL) AS failed, {sql_e6('avg(coalesce(confidence, 0)) FILTER (error IS NULL)')} AS avg_confidence_e6,
  {sql_e6('avg(coalesce(quality_score, 0)) FILTER (error IS NULL)')} AS avg_score_e6 FROM {_RUNS}""")  # fmt: skip
def a6(spark: SparkSession, d: str) -> DataFrame:
    return report.summary(_runs(spark, d)).select("succeeded", "failed", e6("avg_confidence").alias("avg_confidence_e6"), e6("avg_score").alias("avg_score_e6"))


@query("a6_failures", f"SELECT filename, error FROM {_RUNS} WHERE error IS NOT NULL")
def a6_failures(spark: SparkSession, d: str) -> DataFrame:
    return report.failures(_runs(spark, d))


@query("a7_successful", f"SELECT * FROM {_OK}")
def a7(spark: SparkSession, d: str) -> DataFrame:
    return report.successful(_runs(spark, d))


@query("d10_stats", f"SELECT count(*) AS total_documents, {sql_e6('coalesce(avg(confidence), 0)')} AS avg_confidence_e6, (SELECT count(*) FROM {P}) AS total_pages FROM {_LATEST}")
def d10(spark: SparkSession, d: str) -> DataFrame:
    return store.stats(_latest(spark, d), pages(spark, d)).select("total_documents", e6("avg_confidence").alias("avg_confidence_e6"), "total_pages")


@query("d10_distribution", f"SELECT recommendation, count(*) AS n FROM {_LATEST} GROUP BY 1")
def d10_distribution(spark: SparkSession, d: str) -> DataFrame:
    return store.quality_distribution(_latest(spark, d))


@query("d11_problematic", f"SELECT filename, source, confidence, quality_score, recommendation FROM {_LATEST} WHERE quality_score < 75")
def d11(spark: SparkSession, d: str) -> DataFrame:
    return store.problematic(_latest(spark, d))


# --- cleaning

_STRIPPED = f"list_transform(string_split(text, {NL}), lambda x: {sql_strip('x')})"
_HEADERS = f"""(SELECT l.doc_id, l.line, l.n FROM (SELECT doc_id, line, count(*) AS n FROM (SELECT doc_id, unnest(list_filter({_STRIPPED}, lambda x: x <> '')[1:3]) AS line FROM {P} WHERE text IS NOT NULL) WHERE length(line) > 3 GROUP BY 1, 2) l
  JOIN (SELECT doc_id, count(*) AS pages FROM {P} GROUP BY 1) d ON l.doc_id = d.doc_id WHERE pages >= 3 AND n >= greatest(2, CAST(floor(pages * 0.5) AS BIGINT)))"""
_LINES = f"(SELECT doc_id, page_id, unnest(range(0, len(s))) AS line_no, unnest(s) AS line FROM (SELECT doc_id, page_id, {_STRIPPED} AS s FROM {P} WHERE text IS NOT NULL))"
_NORMAL = f"regexp_replace(line, '{SPACE}*[''׳\"״]{SPACE}*', '''', 'g')"
_INTER = " OR ".join([f"regexp_matches(line, 'המשך{SPACE}+.+{SPACE}+בעמוד|המשך{SPACE}+מעמ|המשך{SPACE}+יבוא')", f"regexp_matches({_NORMAL}, 'המשך{SPACE}+בעמ')", *(f"contains({x}, '{p.replace(chr(39), chr(39) * 2)}')" for p in cleaning.PHRASES for x in ("line", _NORMAL))])
_SAME = "len(list_filter(CAST(range(1, least(length(l.line), length(h.line)) + 1) AS BIGINT[]), lambda i: substring(l.line, i, 1) = substring(h.line, i, 1)))"
_LONG = "greatest(length(l.line), length(h.line))"
_SIMILAR = f"CASE WHEN abs(length(l.line) - length(h.line))::DOUBLE / {_LONG} <= 1 - 0.85::DOUBLE THEN {_SAME}::DOUBLE / {_LONG} >= 0.85::DOUBLE ELSE false END"


def _exploded(spark: SparkSession, d: str) -> DataFrame:
    rows = pages(spark, d).select("doc_id", "page_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.withColumn("line", strip(F.col("line")))


@query("t1_repeating_headers", f"SELECT doc_id, line, n FROM {_HEADERS}")
def t1(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.repeating_headers(pages(spark, d))


@query("t2_marked_headers")
def t2(spark: SparkSession, d: str) -> DataFrame:
    own = layout.page_texts(table(spark, d, "ocr_words")).withColumn("page_id", F.xxhash64("doc_id", "page_number"))
    return cleaning.marked_headers(own)


@query("t3_interstitial", f"SELECT page_id, CAST(line_no AS INTEGER) AS line_no FROM {_LINES} WHERE {_INTER}")
def t3(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(spark, d).where(cleaning.is_interstitial(F.col("line"))).select("page_id", "line_no")


@query("t4_header_lines", f"SELECT DISTINCT l.page_id, CAST(l.line_no AS INTEGER) AS line_no FROM {_LINES} l JOIN {_HEADERS} h ON l.doc_id = h.doc_id WHERE l.line <> '' AND (contains(l.line, h.line) OR contains(h.line, l.line) OR {_SIMILAR})")
def t4(spark: SparkSession, d: str) -> DataFrame:
    headers = cleaning.repeating_headers(pages(spark, d)).groupBy("doc_id").agg(F.collect_set("line").alias("headers"))  # a few of each document
    lines = _exploded(spark, d).where("line <> ''").join(headers, "doc_id")
    return lines.where(cleaning.is_header(F.col("line"), F.col("headers"))).select("page_id", "line_no")


@query("t5_similar_lines", f"SELECT DISTINCT l.page_id, CAST(l.line_no AS INTEGER) AS line_no, h.line AS header FROM {_LINES} l JOIN {_HEADERS} h ON l.doc_id = h.doc_id WHERE l.line <> '' AND {_SIMILAR}")
def t5(spark: SparkSession, d: str) -> DataFrame:
    headers = cleaning.repeating_headers(pages(spark, d)).select("doc_id", F.col("line").alias("header"))
    lines = _exploded(spark, d).where("line <> ''").join(headers, "doc_id")
    return lines.where(cleaning.similar(F.col("line"), F.col("header"))).select("page_id", "line_no", "header")


@query("t6_clean_pages")
def t6(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_pages(pages(spark, d))


_COLLAPSED = "text"
for _c in r", \. ; : ! \? \-".split():
    _COLLAPSED = f"regexp_replace({_COLLAPSED}, '{_c}{{2,}}', '{_c[-1]}', 'g')"


@query("t7_collapsed", f"SELECT page_id, md5({_COLLAPSED}) AS text_md5 FROM {P}")
def t7(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", F.md5(cleaning.collapse_punctuation(F.col("text"))).alias("text_md5"))


@query("t8_parentheses", f"""SELECT page_id, md5(CASE WHEN length(s) >= 2 AND length(replace(s, '(', '')) * 2 = length(s) AND coalesce(list_min(list_transform(CAST(range(1, length(s) + 1) AS BIGINT[]),
  lambda i: length(replace(s[1:i], ')', '')) - length(replace(s[1:i], '(', '')))), 0) < 0 THEN translate(text, '()', ')(') ELSE text END) AS text_md5 FROM (SELECT page_id, text, regexp_replace(text, '[^()]', '', 'g') AS s FROM {P})""")  # fmt: skip
def t8(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", F.md5(cleaning.fix_parentheses(F.col("text"))).alias("text_md5"))


_STEM = "regexp_replace(filename, '(.)\\.[^./]*$', '\\1')"
_PARTS = f"list_filter(string_split_regex({_STEM}, '[_\\-{SPACE[1:-1]}]+'), lambda x: x <> '' AND NOT regexp_full_match(x, '\\p{{Nd}}+'))"
_YEAR = f"regexp_extract({_STEM}, '[תש][שׁ][פצ][\"״׳'']?[א-ת]')"
_INFO = f"(SELECT DISTINCT filename, regexp_extract({_STEM}, '\\p{{Nd}}+') AS issue_number, CASE WHEN {_YEAR} <> '' THEN {_YEAR} ELSE coalesce({_PARTS}[1], '') END AS issue_date FROM documents)"


@query("t9_issue_info", f"SELECT * FROM {_INFO}")
def t9(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("filename", cleaning.issue_info(F.col("filename")).alias("x")).select("filename", "x.*").distinct()


_TEMPLATE = "'" + cleaning.Cleaning().template.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


@query("t10_issue_header", f"SELECT filename, md5(replace(replace({_TEMPLATE}, '{{issue_number}}', issue_number), '{{issue_date}}', issue_date)) AS header_md5 FROM {_INFO}")
def t10(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "documents").select("filename").distinct()
    return own.select("filename", F.md5(cleaning.issue_header(cleaning.issue_info(F.col("filename")))).alias("header_md5"))


@query("t11_without_markers")
def t11(spark: SparkSession, d: str) -> DataFrame:
    return layout.page_texts(table(spark, d, "ocr_words")).select("doc_id", "page_number", cleaning.strip_markers(F.col("text")).alias("text"))


_CORRECTIONS = (("...", "…"), (" ,", ","), ("…", "..."))


@query("t12_corrected", f"SELECT page_id, md5(replace(replace(replace(text, '...', '…'), ' ,', ','), '…', '...')) AS text_md5 FROM {P}")
def t12(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", F.md5(cleaning.correct(F.col("text"), cleaning.Cleaning(corrections=_CORRECTIONS))).alias("text_md5"))


@query("t13_source", f"SELECT DISTINCT filename, coalesce(list_filter(string_split_regex(translate({_STEM}, '_-', '  '), '\\s+'), lambda x: x <> '' AND NOT regexp_full_match(x, '\\p{{Nd}}+'))[1], {_STEM}) AS source FROM documents")
def t13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("filename", report.extract_source(F.col("filename")).alias("source")).distinct()


# --- dictionary

_AMBIGUOUS = ", ".join(f"'{w}'" for w in words.AMBIGUOUS)
_DICT = f"(SELECT DISTINCT {sql_strip('word')} AS word FROM dictionary WHERE {sql_strip('word')} <> '')"
_OCC = f"(SELECT id, unnest(regexp_extract_all(coalesce(text, ''), '{H}{{2,}}')) AS word FROM texts)"
_FORMS = "list_filter([w, CASE WHEN length(w) > 2 AND contains('בהוכלמש', w[1]) THEN substring(w, 2) END, CASE WHEN length(w) > 3 AND substring(w, 1, 2) IN ('מה', 'של', 'בה', 'לה', 'וה', 'כש', 'מש') THEN substring(w, 3) END], lambda x: x IS NOT NULL)"


def _known(source: str) -> str:
    return f"(SELECT DISTINCT w AS word FROM (SELECT w, unnest({_FORMS}) AS form FROM (SELECT DISTINCT word AS w FROM {source})) f SEMI JOIN {_DICT} d ON f.form = d.word)"


_ABBREVIATED = "(" + ", ".join(f"'{w}'" for w in words.ABBREVIATIONS) + ")"


def _words(spark: SparkSession, d: str) -> DataFrame:
    return words.occurrences(table(spark, d, "texts"), "id")


@query("s7_dictionary", f"SELECT word FROM {_DICT}")
def s7(spark: SparkSession, d: str) -> DataFrame:
    return words.dictionary_words(table(spark, d, "dictionary"))


@query("c1_words", f"SELECT id, word, count(*) AS n FROM {_OCC} GROUP BY 1, 2")
def c1(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d).groupBy("id", "word").agg(F.count("*").alias("n"))


@query("c2_known", f"SELECT word FROM {_known(_OCC)}")
def c2(spark: SparkSession, d: str) -> DataFrame:
    return words.known(_words(spark, d), table(spark, d, "dictionary"))


@query("c3_check", f"""SELECT t.id, count(o.word) FILTER (k.word IS NOT NULL) AS valid_words, count(o.word) FILTER (k.word IS NULL) AS unknown_words, count(o.word) AS total_words,
  coalesce(count(o.word) FILTER (k.word IS NOT NULL)::DOUBLE / nullif(count(o.word), 0), 0) AS accuracy FROM texts t LEFT JOIN {_OCC} o ON t.id = o.id LEFT JOIN {_known(_OCC)} k ON o.word = k.word GROUP BY t.id""")  # fmt: skip
def c3(spark: SparkSession, d: str) -> DataFrame:
    return words.check(table(spark, d, "texts"), table(spark, d, "dictionary"), "id").select("id", "valid_words", "unknown_words", "total_words", "accuracy")


@query("c3_lists")
def c3_lists(spark: SparkSession, d: str) -> DataFrame:
    return words.check(table(spark, d, "texts"), table(spark, d, "dictionary"), "id").select("id", "unknown_list", "suggestions")


@query("c4_closest", f"""SELECT u.word, min(d.word) AS suggestion FROM (SELECT DISTINCT word FROM {_OCC} WHERE word NOT IN (SELECT word FROM {_known(_OCC)})) u JOIN {_DICT} d
  ON abs(length(u.word) - length(d.word)) <= 1 WHERE regexp_matches(d.word, '{H}') AND levenshtein(u.word, d.word) <= 4 AND length(u.word) > 0
  AND (length(u.word) = length(d.word) AND len(list_filter(CAST(range(1, length(u.word) + 1) AS BIGINT[]), lambda i: substring(u.word, i, 1) <> substring(d.word, i, 1))) = 1
  OR length(u.word) = length(d.word) + 1 AND list_contains(list_transform(CAST(range(1, length(u.word) + 1) AS BIGINT[]), lambda i: substring(u.word, 1, i - 1) || substring(u.word, i + 1)), d.word)
  OR length(u.word) + 1 = length(d.word) AND list_contains(list_transform(CAST(range(1, length(d.word) + 1) AS BIGINT[]), lambda i: substring(d.word, 1, i - 1) || substring(d.word, i + 1)), u.word)) GROUP BY u.word""")  # fmt: skip
def c4(spark: SparkSession, d: str) -> DataFrame:
    own, entries = _words(spark, d), table(spark, d, "dictionary")
    return words.closest(own.select("word").distinct().join(words.known(own, entries), "word", "left_anti"), entries)


@query("c5_distance", "SELECT id, CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '  +', ' ', 'g')) AS INTEGER) AS distance FROM texts WHERE length(text) <= 2000")
def c5(spark: SparkSession, d: str) -> DataFrame:
    """Edits between a text and itself with single blanks: as many as it has blanks too many."""
    own = table(spark, d, "texts").where(F.length("text") <= 2000)
    return own.select("id", F.levenshtein("text", F.regexp_replace("text", "  +", " ")).alias("distance"))


@query("c6_known_or_abbreviation", f"SELECT word FROM {_known(_OCC)} UNION SELECT word FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM texts) WHERE word IN {_ABBREVIATED}")
def c6(spark: SparkSession, d: str) -> DataFrame:
    tokens = table(spark, d, "texts").select(F.explode(F.split("text", r"\s+")).alias("word")).where(F.col("word").isin(*words.ABBREVIATIONS))
    return words.known(_words(spark, d).select("word").unionAll(tokens), table(spark, d, "dictionary"), abbreviations=True)


@query("c7_has_dictionary", f"SELECT count(*) > 0 AS has_dictionary FROM {_DICT}")
def c7(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(1).select(F.lit(words.has_dictionary(table(spark, d, "dictionary"))).alias("has_dictionary"))


_AROUND = "['׳.,;:!?)(]".replace("'", "''")


@query("t14_flagged_texts", f"SELECT page_id, len(list_filter(string_split_regex(text, '{SPACE}+'), lambda x: regexp_replace(x, '^{_AROUND}+|{_AROUND}+$', '', 'g') IN ({_AMBIGUOUS}))) AS n FROM {P} WHERE text IS NOT NULL")
def t14(spark: SparkSession, d: str) -> DataFrame:
    flagged = words.flag_ambiguous(F.col("text"))
    return pages(spark, d).where("text is not null").select("page_id", (F.regexp_count(flagged, F.lit("⚠️")) / 2 - F.regexp_count("text", F.lit("⚠️")) / 2).cast("long").alias("n"))


@query("t14_flagged_words")
def t14_words(spark: SparkSession, d: str) -> DataFrame:
    return words.flag_words(table(spark, d, "ocr_words"), layout.KEYS)


@query("t15_fixed_words")
def t15(spark: SparkSession, d: str) -> DataFrame:
    return words.fix_words(table(spark, d, "ocr_words"), table(spark, d, "dictionary"), layout.KEYS)


@query("t15_fixed_texts")
def t15_texts(spark: SparkSession, d: str) -> DataFrame:
    return words.fix_texts(table(spark, d, "texts"), table(spark, d, "dictionary"), "id")


_SWAPS = ", ".join(f"({chr(39)}{k}{chr(39)}, {chr(39)}{v}{chr(39)})" for k, vs in words.CONFUSED.items() for v in vs)
_KNOWN_PLUS = f"(SELECT word FROM {_DICT} UNION SELECT unnest({_ABBREVIATED.replace('(', '[').replace(')', ']')}))"


@query("t16_swaps", f"""WITH s(a, b) AS (VALUES {_SWAPS}), w AS (SELECT DISTINCT word FROM {_OCC}), u AS (SELECT word FROM w WHERE word NOT IN (SELECT word FROM {_known(_OCC)})),
  i AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM u), c AS (SELECT word, substring(word, 1, i - 1) || b AS head, substring(word, i + 1) AS tail, i - 1 AS pos FROM i JOIN s ON substring(word, i, 1) = a),
  k AS (SELECT word, head || tail AS candidate, pos FROM c), f AS (SELECT word, candidate, pos, unnest({_FORMS.replace('w[1]', 'substring(candidate, 1, 1)').replace('(w)', '(candidate)').replace('(w,', '(candidate,').replace('[w,', '[candidate,')}) AS form FROM k),
  h AS (SELECT DISTINCT word, candidate, pos FROM f SEMI JOIN {_DICT} d ON f.form = d.word) SELECT word, candidate, CAST(pos AS INTEGER) AS at, count(*) OVER (PARTITION BY word) AS n FROM h""")  # fmt: skip
def t16(spark: SparkSession, d: str) -> DataFrame:
    return words.confusion_fixes(_words(spark, d), table(spark, d, "dictionary"))


@query("t17_tokens", f"SELECT id, CAST(len(regexp_extract_all(text, '{SPACE}+|[^{SPACE[1:]}+')) AS INTEGER) AS n, true AS whole FROM texts WHERE text <> ''")
def t17(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "texts").where("text <> ''").withColumn("tokens", words.tokens(F.col("text")))
    return own.select("id", F.size("tokens").alias("n"), (F.array_join("tokens", "") == F.col("text")).alias("whole"))


# --- store

_LAST = "(SELECT filename, max(batch) AS batch FROM store_batches GROUP BY filename)"
_STORED_PAGES = f"(SELECT s.filename, page_number, max(text) AS text, s.batch FROM store_batches s JOIN {_LAST} l ON s.filename = l.filename AND s.batch = l.batch GROUP BY 1, 2, 4)"


def _batches(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "store_batches")


@query("s8_unprocessed", f"SELECT filename FROM documents d WHERE {_STEM} NOT IN (SELECT {_STEM} FROM {_OK})")
def s8(spark: SparkSession, d: str) -> DataFrame:
    return store.unprocessed(table(spark, d, "documents").select("filename"), report.successful(_runs(spark, d)))


@query("o2_pilot", f"SELECT filename FROM (SELECT filename FROM documents ORDER BY filename LIMIT 100) WHERE {_STEM} NOT IN (SELECT {_STEM} FROM {_OK})")
def o2(spark: SparkSession, d: str) -> DataFrame:
    return store.pilot(table(spark, d, "documents").select("filename"), 100, report.successful(_runs(spark, d)))


@query("d2_documents", f"SELECT filename, count(*) AS pages, batch FROM {_STORED_PAGES} GROUP BY 1, 3")
def d2(spark: SparkSession, d: str) -> DataFrame:
    return store.stored_documents(_batches(spark, d))


@query("d3_pages", f"SELECT * FROM {_STORED_PAGES}")
def d3(spark: SparkSession, d: str) -> DataFrame:
    return store.stored_pages(_batches(spark, d))


@query("d3_orphans", f"SELECT DISTINCT s.filename, page_number, s.batch FROM store_batches s JOIN {_LAST} l ON s.filename = l.filename WHERE s.batch < l.batch")
def d3_orphans(spark: SparkSession, d: str) -> DataFrame:
    return store.orphans(_batches(spark, d))


@query("s11_upsert", f"SELECT s.filename, s.page_number, max(s.text) AS text FROM store_batches s JOIN {_LAST} l ON s.filename = l.filename AND s.batch = l.batch GROUP BY 1, 2")
def s11(spark: SparkSession, d: str) -> DataFrame:
    """The last batch put over all earlier ones in one step equals the whole history."""
    own = _batches(spark, d)
    last = own.agg(F.max("batch").alias("last"))
    rows = own.join(F.broadcast(last))  # one row
    old, new = (store.stored_pages(rows.where(c).select(*own.columns)).drop("batch") for c in ("batch < last", "batch = last"))
    return store.upsert_pages(old, new, new)


_CACHE = "(SELECT doc_id, page_number, arg_min(CASE WHEN symbol_confidences IS NULL THEN 0 ELSE 1 END, word_idx) AS usable FROM ocr_words GROUP BY 1, 2)"


def _cache(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    own = table(spark, d, "ocr_words")
    by = own.groupBy(*layout.KEYS).agg(F.min_by(F.struct("text", "confidence", "bbox", "symbol_confidences"), "word_idx").alias("first"))
    image = F.encode(F.concat_ws("/", *layout.KEYS), "UTF-8")
    return by.select(*layout.KEYS, image.alias("image")), by.select(ocr.cache_key(image).alias("cache_key"), F.array("first").alias("words"))


@query("s5_cache_hits", f"SELECT doc_id, page_number, md5(doc_id || '/' || page_number) AS cache_key FROM {_CACHE} WHERE usable = 1")
def s5(spark: SparkSession, d: str) -> DataFrame:
    pages_, cache = _cache(spark, d)
    return ocr.cache_hits(pages_, cache).select(*layout.KEYS, "cache_key")


@query("s5_cache_misses", f"SELECT doc_id, page_number FROM {_CACHE} WHERE usable = 0")
def s5_misses(spark: SparkSession, d: str) -> DataFrame:
    pages_, cache = _cache(spark, d)
    return ocr.cache_misses(pages_, cache).select(*layout.KEYS)


# --- search

_A, _B = search.folding()
_TERMS = f"regexp_extract_all(translate(regexp_replace(lower(coalesce(text, '')), '[\\x{{300}}-\\x{{331}}]+', '', 'g'), '{_A}', '{_B}'), '[\\p{{L}}\\p{{N}}\\p{{Co}}]+')"
_POST = f"(SELECT term, page_id, count(*) AS tf FROM (SELECT page_id, unnest({_TERMS}) AS term FROM {P}) GROUP BY 1, 2)"
_LEN = f"(SELECT page_id, len({_TERMS}) AS len FROM {P})"
_ONE, _TWO, _NOT = "עיתון", "שכונה", "רכבת"


def _bm25(*terms: str) -> str:
    parts = " UNION ALL ".join(f"SELECT page_id, tf, (SELECT count(*) FROM {_POST} WHERE term = '{t}') AS df FROM {_POST} WHERE term = '{t}'" for t in terms)
    return f"""(SELECT x.page_id, -sum((CASE WHEN ln((n - df + 0.5) / (df + 0.5)) <= 0 THEN 1e-6 ELSE ln((n - df + 0.5) / (df + 0.5)) END) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))) AS rank
      FROM ({parts}) x JOIN {_LEN} l ON x.page_id = l.page_id CROSS JOIN (SELECT count(*)::DOUBLE AS n, avg(len) AS mean FROM {_LEN}) GROUP BY x.page_id)"""


@query("d8_postings", f"SELECT term, page_id, tf FROM {_POST}")
def d8(spark: SparkSession, d: str) -> DataFrame:
    return search.postings(pages(spark, d)).select("term", "page_id", "tf")


@query("d8_lengths", f"SELECT page_id, CAST(len AS INTEGER) AS len FROM {_LEN}")
def d8_lengths(spark: SparkSession, d: str) -> DataFrame:
    return search.page_lengths(pages(spark, d))


@query("d6_rank", f"SELECT page_id, {sql_e6('rank')} AS rank_e6 FROM {_bm25(_ONE, _TWO)}")
def d6(spark: SparkSession, d: str) -> DataFrame:
    own = pages(spark, d)
    return search.ranked(search.postings(own), search.page_lengths(own), f"{_ONE} OR {_TWO}").select("page_id", e6("rank").alias("rank_e6"))


@query("d7_boolean", f"SELECT page_id FROM {_POST} WHERE term = '{_ONE}' AND page_id IN (SELECT page_id FROM {_POST} WHERE starts_with(term, '{_TWO[:3]}')) AND page_id NOT IN (SELECT page_id FROM {_POST} WHERE term = '{_NOT}')")
def d7(spark: SparkSession, d: str) -> DataFrame:
    q = search.Query(f"{_ONE} {_TWO[:3]}* NOT {_NOT}")
    return search.matches(search.postings(pages(spark, d)), q).where("matched").select("page_id")


@query("d7_phrase", f"SELECT page_id FROM (SELECT page_id, {_TERMS} AS t FROM {P}) WHERE contains(' ' || array_to_string(t, ' ') || ' ', ' של את ')")
def d7_phrase(spark: SparkSession, d: str) -> DataFrame:
    return search.matches(search.postings(pages(spark, d)), search.Query('"של את"')).where("matched").select("page_id")


def _searched(spark: SparkSession, d: str) -> DataFrame:
    runs = _latest(spark, d).select("filename", "source", "confidence")
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "filename", F.col("year").cast("string").alias("year")).join(runs, "filename")
    return search.search(pages(spark, d).select("page_id", "doc_id", "page_number", "text"), docs, f"{_ONE} OR {_TWO}")


@query("d5_search", f"""SELECT r.page_id, d.filename, p.page_number, {sql_e6('rank')} AS rank_e6 FROM {_bm25(_ONE, _TWO)} r JOIN {P} p ON r.page_id = p.page_id JOIN documents d ON CAST(d.doc_id AS VARCHAR) = p.doc_id
  JOIN {_LATEST} l ON d.filename = l.filename ORDER BY rank, r.page_id LIMIT 20""")  # fmt: skip
def d5(spark: SparkSession, d: str) -> DataFrame:
    return _searched(spark, d).select("page_id", "filename", "page_number", e6("rank").alias("rank_e6"))


@query("d9_snippets")
def d9(spark: SparkSession, d: str) -> DataFrame:
    return _searched(spark, d).select("page_id", "snippet")


# --- words and layout

_X, _Y = "list_transform(bbox, lambda p: p[1])", "list_transform(bbox, lambda p: p[2])"
_GEO = f"""(SELECT *, (x_min + x_max) / 2 AS x_center, (y_min + y_max) / 2 AS y_center, y_max - y_min AS height FROM (SELECT doc_id, page_number, word_idx, {sql_strip('text')} AS text, list_min({_X}) AS x_min, list_max({_X}) AS x_max,
  list_min({_Y}) AS y_min, list_max({_Y}) AS y_max FROM ocr_words WHERE len(bbox) > 0) WHERE text <> '')"""
_EXT = f"(SELECT doc_id, page_number, count(*) AS n_words, min(x_min) AS x_min, max(x_max) AS x_max, max(x_max) - min(x_min) AS width FROM {_GEO} GROUP BY 1, 2)"
_HIST = f"""(SELECT doc_id, page_number, CAST(least(floor((x_center - left_) / step), floor(width / step)) AS INTEGER) AS bin, count(*) AS n FROM (SELECT g.*, e.x_min AS left_, e.width, greatest(30.0::DOUBLE, e.width / 40) AS step FROM {_GEO} g
  JOIN {_EXT} e ON g.doc_id = e.doc_id AND g.page_number = e.page_number WHERE e.width > 0) GROUP BY 1, 2, 3)"""


def _ocr(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ocr_words")


@query("l1_geometry", f"SELECT * FROM {_GEO}")
def l1(spark: SparkSession, d: str) -> DataFrame:
    return layout.geometry(_ocr(spark, d))


@query("l2_extents", f"SELECT * FROM {_EXT}")
def l2(spark: SparkSession, d: str) -> DataFrame:
    return layout.extents(_ocr(spark, d))


@query("l3_lines")
def l3(spark: SparkSession, d: str) -> DataFrame:
    return layout.text_lines(_ocr(spark, d))


@query("l4_average_height", f"""SELECT doc_id, page_number, {sql_e6('CASE WHEN n = 0 THEN 30.0::DOUBLE ELSE list_avg(h[1 + k : n - k]) END')} AS avg_height_e6 FROM (SELECT *, CASE WHEN n > 20 THEN greatest(1, n // 10) ELSE 0 END AS k FROM
  (SELECT doc_id, page_number, coalesce(list_sort(list(height) FILTER (height > 5)), []) AS h, count(*) FILTER (height > 5) AS n FROM {_GEO} GROUP BY 1, 2))""")  # fmt: skip
def l4(spark: SparkSession, d: str) -> DataFrame:
    return layout.average_heights(_ocr(spark, d)).select("doc_id", "page_number", e6("avg_height").alias("avg_height_e6"))


@query("l7_histogram", f"SELECT doc_id, page_number, bin, n FROM {_HIST}")
def l7(spark: SparkSession, d: str) -> DataFrame:
    return layout.histogram(_ocr(spark, d))


@query("l7_boundaries")
def l7_boundaries(spark: SparkSession, d: str) -> DataFrame:
    return layout.boundaries(_ocr(spark, d))


@query("l11_regions")
def l11(spark: SparkSession, d: str) -> DataFrame:
    return layout.regions(_ocr(spark, d))


@query("l14_page_texts")
def l14(spark: SparkSession, d: str) -> DataFrame:
    return layout.page_texts(_ocr(spark, d))


@query("w2_deduplicated")
def w2(spark: SparkSession, d: str) -> DataFrame:
    return layout.deduplicated(_ocr(spark, d))


@query("w3_quotes_detached")
def w3(spark: SparkSession, d: str) -> DataFrame:
    return layout.with_quotes_detached(_ocr(spark, d))


@query("i1_image_quality")
def i1(spark: SparkSession, d: str) -> DataFrame:
    pixels = F.transform("embedding", lambda x: F.pmod((x * 1000).cast("int"), F.lit(256)))
    own = table(spark, d, "embeddings").select("vec_id", F.lit(8).alias("height"), F.floor(F.size("embedding") / 8).cast("int").alias("width"), pixels.alias("pixels"))
    return images.assess(own.select("vec_id", "height", "width", F.slice("pixels", F.lit(1), F.col("height") * F.col("width")).alias("pixels")), "vec_id")

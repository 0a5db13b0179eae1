"""Words against a dictionary: known words, suggestions, ambiguous words, confused letters.

Texts are exploded to distinct words before any lookup, so that a word is looked up once for
the whole corpus. The dictionary enters joins by a size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import HEBREW, SPACE, strip, strip_of
from quire.workspace import narrow, staged

# Letters that may stand before a word, alone or in pairs.
PREFIXES, PAIRS = "בהוכלמש", ("מה", "של", "בה", "לה", "וה", "כש", "מש")
# Letters that are easily taken for each other.
CONFUSED = {
    "כ": ["נ"], "נ": ["כ"], "ד": ["ר"], "ר": ["ד"], "ב": ["כ"], "ה": ["ח", "ת"], "ח": ["ה", "ת"], "ת": ["ה", "ח"], "ו": ["ז"], "ז": ["ו"],
    "ם": ["ס"], "ס": ["ם"], "ע": ["צ"], "צ": ["ע"], "ן": ["ו"], "ף": ["ק"], "ק": ["ף"],
}
# Words that are read in two ways.
AMBIGUOUS = ('כמש"כ', 'כמש"נ', 'כ"מ', 'נ"מ', 'ב"כ', 'ב"נ')
# Abbreviations that count as known.
ABBREVIATIONS = """
כמש"כ כמש"נ כמ"ש עי"ש וע"ש ע"ש ז"ל זצ"ל זי"ע זיע"א שליט"א נ"י ע"ה הי"ד הי"ו יבדל"א ע"א ע"ב ע"פ ע"ד ע"כ ע"ז ע"י ע"ג ע"ע ב"ה בע"ה בעז"ה אי"ה בס"ד ה"ה ד"ה וד"ה ס"ק
הקב"ה כביכ"ל מש"כ שנ"ל אע"פ אעפ"כ אא"כ אע"ג שבת"ל ר"ל ח"ו חלי"ל א"כ א"ל א"א א"ר ב"ד ב"ב ב"ר ב"ק ב"מ ב"כ ב"נ ג"כ ג"ע ד"א ד"ת ד"מ ה"א ה"ד ה"ק ה"נ ו"ק ו"ל י"ל י"א י"ט י"ג
כ"כ כ"ג כ"א כ"ד כ"ה כ"ו כ"ז כ"ח כ"ט ל"א ל"ב ל"ג ל"ד ל"ה ל"ו ל"ז ל"ח ל"ט מ"מ מ"ש מ"ע נ"ל נ"מ נ"ע צ"ל צ"ע צ"ב ר"ת ר"י ר"ה ר"ש ר"ע ר"ן ר"א ר"ב ר"מ ר"פ ס"ת ס"ל ת"ל ת"ח ת"ר
תוס"ד וכה"ג כה"ג פ"א פ"ב פ"ג פ"ד פ"ה פ"ו פ"ז פ"ח פ"ט פ"ק ס"א ס"ב ס"ג ס"ד ס"ה ס"ו ס"ז ס"ח ס"ט ספה"ק דב"ק אות"ו אות"ה אות"ן אות"ם כ"מ מ"ב מ"א שו"ע שו"ת או"ח י"ד אה"ע חו"מ הל"מ מ"צ מצ"ע תנ"ך
""".split()
HIGH, LOW = 0.95, 0.85
SUGGESTED, LISTED = 50, 100


def dictionary_words(words: DataFrame) -> DataFrame:
    """``word``: distinct non-blank entries."""
    return words.select(strip(F.col("word")).alias("word")).where("word <> ''").distinct()


def has_dictionary(words: DataFrame) -> bool:
    return not dictionary_words(words).isEmpty()


def hebrew_words(t: Column) -> Column:
    """Runs of at least two Hebrew characters, in order."""
    return F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(f"({HEBREW}{{2,}})"), 1)


def forms(word: Column) -> Column:
    """The word itself and without a prefix of one letter or two: it is known if any of them is."""
    one = F.when((F.length(word) > 2) & F.lit(PREFIXES).contains(F.substring(word, 1, 1)), F.substring(word, F.lit(2), F.length(word)))
    two = F.when((F.length(word) > 3) & F.substring(word, 1, 2).isin(*PAIRS), F.substring(word, F.lit(3), F.length(word)))
    return F.array_compact(F.array(word, one, two))


def known(words: DataFrame, dictionary: DataFrame, abbreviations: bool = False, column: str = "word") -> DataFrame:
    """The distinct ``word`` rows that are known, as they are or without a prefix."""
    entries = narrow(staged(dictionary_words(dictionary)))
    words = words.select(column).distinct()
    hit = words.select(column, F.explode(forms(F.col(column))).alias("form")).join(entries.withColumnRenamed("word", "form"), "form", "left_semi").select(column)
    if abbreviations:
        hit = hit.unionAll(words.where(F.col(column).isin(*ABBREVIATIONS)))
    return hit.distinct()


def occurrences(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, pos, word`` of the Hebrew words of each text."""
    return texts.select(key, F.posexplode(hebrew_words(F.col(text))).alias("pos", "word"))


def closest(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``word, suggestion``: the least dictionary word at one edit from each given word.

    Two words at one edit have a common form among themselves and themselves without one letter: an equi-join, then the exact distance."""

    def neighbours(w: Column) -> Column:
        return F.array_distinct(F.concat(F.array(w), F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))))

    entries = dictionary_words(dictionary)
    near = narrow(staged(entries.select(F.col("word").alias("suggestion"), F.explode(neighbours(F.col("word"))).alias("near"))))
    mine = words.select("word").distinct().where("word <> ''").select("word", F.explode(neighbours(F.col("word"))).alias("near"))
    pairs = mine.join(near, "near").where(F.levenshtein("word", "suggestion", 1) == 1)
    return pairs.groupBy("word").agg(F.min("suggestion").alias("suggestion"))


def check(texts: DataFrame, dictionary: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row for each text: numbers of its words, and of the unknown ones, the share known, the first unknown words and suggestions for the first of them."""
    words = staged(occurrences(texts, key, text))
    good = staged(known(words, dictionary))
    missing = staged(words.select("word").distinct().join(narrow(good), "word", "left_anti"))
    near = narrow(staged(closest(missing, dictionary)))
    marked = words.join(narrow(missing).withColumn("unknown", F.lit(1)), "word", "left").join(near, "word", "left")
    unknown = F.col("unknown").isNotNull()
    first = F.sort_array(F.collect_list(F.when(unknown, F.struct("pos", "word", "suggestion"))))  # words of one text
    out = marked.groupBy(key).agg(F.count("*").alias("total_words"), F.count_if(unknown).alias("unknown_words"), first.alias("own"))
    out = texts.select(key).join(out, key, "left")
    total, bad = F.coalesce("total_words", F.lit(0)), F.coalesce("unknown_words", F.lit(0))
    near50 = F.filter(F.slice("own", 1, SUGGESTED), lambda x: x.suggestion.isNotNull())
    empty = F.array().cast("array<string>")
    return out.select(
        key, (total - bad).alias("valid_words"), bad.alias("unknown_words"), total.alias("total_words"), F.coalesce(F.try_divide((total - bad).cast("double"), total.cast("double")), F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.transform(F.slice("own", 1, LISTED), lambda x: x.word), empty).alias("unknown_list"),
        F.coalesce(F.transform(near50, lambda x: F.struct(x.word.alias("word"), x.suggestion.alias("suggestion"), F.lit(0.9).alias("confidence"))), F.array().cast("array<struct<word:string,suggestion:string,confidence:double>>")).alias("suggestions"),
    )


def tokens(t: Column) -> Column:
    """Tokens and the white space between them, in order; joined they are the text."""
    inner = SPACE[1:-1]
    return F.split(t, f"(?<=[{inner}])(?=[^{inner}])|(?<=[^{inner}])(?=[{inner}])")


_AROUND = "'׳.,;:!?)("


def flag_ambiguous(t: Column) -> Column:
    """Words that are read in two ways, between warning signs."""
    own = "|".join(sorted(AMBIGUOUS, key=len, reverse=True))
    return F.regexp_replace(t, f"(?<![^{SPACE[1:]})([{_AROUND}]*(?:{own})[{_AROUND}]*)(?![^{SPACE[1:]})", "⚠️$1⚠️")


def flag_words(words: DataFrame, keys: list[str]) -> DataFrame:
    """The word rows with ``flagged``: ambiguous words some כ or נ of which was read with less than high confidence, or without any confidence.

    The last word of the same text on a page lends its confidences to all of them."""
    clean = strip_of(F.col("text"), _AROUND)
    pages = words.where(F.col("text").rlike("|".join(AMBIGUOUS)))
    last = pages.where(F.size("symbol_confidences") > 0).groupBy(*keys, "text").agg(F.max_by("symbol_confidences", "word_idx").alias("confidences"))
    own = words.select(*keys, "word_idx", "text", clean.alias("clean"))
    by_token = own.where(F.col("clean").isin(*AMBIGUOUS)).join(last, [*keys, "text"], "left")
    by_clean = by_token.join(last.select(*keys, F.col("text").alias("clean"), F.col("confidences").alias("of_clean")), [*keys, "clean"], "left")
    sure = F.coalesce("confidences", "of_clean")
    doubtful = F.exists(
        F.sequence(F.lit(1), F.length("clean")),
        lambda i: F.substring(F.col("clean"), i, F.lit(1)).isin("כ", "נ") & (i <= F.size(sure)) & (F.coalesce(F.try_element_at(sure, i).confidence, F.lit(1.0)) < HIGH),
    )
    return by_clean.select(*keys, "word_idx", "text", (sure.isNull() | doubtful).alias("flagged"))


def swaps(word: Column) -> Column:
    """``candidate, at`` of every change of one letter for one it is confused with."""
    table = F.create_map(*(x for k, v in CONFUSED.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))

    def at(i: Column) -> Column:
        other = F.coalesce(F.try_element_at(table, F.substring(word, i, F.lit(1))), F.array().cast("array<string>"))
        return F.transform(other, lambda c: F.struct(F.concat(F.substring(word, F.lit(1), i - 1), c, F.substring(word, i + 1, F.length(word))).alias("candidate"), (i - 1).alias("at")))

    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(word)), at))


def confusion_fixes(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``word, candidate, at, n``: known candidates of each unknown word and their number; with one candidate it is the right word."""
    asked = words.select("word").distinct().where("word <> ''")
    unknown = staged(asked.join(known(asked, dictionary, abbreviations=True), "word", "left_anti"))
    tried = staged(unknown.select("word", F.inline(swaps(F.col("word")))))
    hits = tried.join(known(tried, dictionary, abbreviations=True, column="candidate"), "candidate", "left_semi")
    n = hits.groupBy("word").agg(F.count("*").alias("n"))
    return hits.join(n, "word").select("word", "candidate", "at", "n")


def fix_words(words: DataFrame, dictionary: DataFrame, keys: list[str]) -> DataFrame:
    """Word rows ``keys, word_idx, text, symbol_confidences`` with ``fixed``: the one known word at one confused letter.

    With several candidates, the one whose letter was read with the least confidence, the first of equals, if that is low; else the word stays."""
    edge = "'׳"
    rows = words.select(*keys, "word_idx", "text", "symbol_confidences", strip_of(F.col("text"), edge).alias("word"))
    fixes = narrow(staged(confusion_fixes(rows, dictionary)))
    sure = F.coalesce(F.try_element_at("symbol_confidences", F.col("at") + 1).confidence, F.lit(1.0))
    hits = rows.select(*keys, "word_idx", "word", "symbol_confidences").join(fixes, "word").withColumn("sure", sure)
    best = hits.groupBy(*keys, "word_idx").agg(F.min(F.struct("sure", "at", "candidate")).alias("best"), F.max("n").alias("n"))
    best = best.where((F.col("n") == 1) | (F.col("best.sure") < LOW)).select(*keys, "word_idx", F.col("best.candidate").alias("to"))
    before, after = F.regexp_extract("text", f"^[{edge}]*", 0), F.regexp_extract("text", f"[{edge}]*$", 0)
    fixed = F.when(F.col("to").isNotNull() & (F.col("word") != ""), F.concat(before, "to", after)).otherwise(F.col("text"))
    return rows.join(best, [*keys, "word_idx"], "left").select(*keys, "word_idx", "text", fixed.alias("fixed"))


def fix_texts(texts: DataFrame, dictionary: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, text``: texts with the words that have exactly one candidate put right."""
    parts = staged(texts.select(key, F.posexplode(tokens(F.coalesce(F.col(text), F.lit("")))).alias("pos", "token")).withColumn("word", strip_of(F.col("token"), "'׳")))
    fixes = narrow(staged(confusion_fixes(parts.where(~F.col("token").rlike(f"^{SPACE}*$")), dictionary).where("n = 1").select("word", "candidate")))
    fixed = F.when(F.col("candidate").isNotNull(), F.concat(F.regexp_extract("token", "^['׳]*", 0), "candidate", F.regexp_extract("token", "['׳]*$", 0))).otherwise(F.col("token"))
    out = parts.join(fixes, "word", "left").select(key, "pos", fixed.alias("token")).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("own"))  # tokens of one text
    return out.select(key, F.array_join(F.transform("own", lambda x: x.token), "").alias("text"))

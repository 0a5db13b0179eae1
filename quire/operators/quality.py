"""Checks of a text and its score: one narrow pass of built-in expressions, no shuffle, no Python.

Null texts count as empty; null or non-positive page numbers as one page.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import HEBREW, NIKUD, count_of, is_blank, round_half_even, strip

# Signs that don't belong into such texts, final letters and their regular forms, one-letter words.
WEIRD = "@#$©™®□■◊◆●○►◄▲▼"
FINAL, REGULAR = "ךםןףץ", "כמנפצ"
SINGLE = "בהוכלמשא"


@dataclass(frozen=True)
class Limits:
    hebrew_ratio: float = 0.85
    weird: int = 10
    page_min: int = 500
    page_max: int = 5000
    spacing: int = 50
    finals: int = 10
    double_nikud: int = 5
    stray_nikud: int = 3
    single: int = 10
    repeated: int = 5
    listed: int = 20


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def hebrew_ratio(t: Column, limits: Limits = Limits()) -> Column:
    hebrew, letters = count_of(t, HEBREW), count_of(t, r"\p{L}")
    blank = is_blank(t)
    none = blank | (letters == 0)
    ratio = F.when(none, 0.0).otherwise(F.try_divide(hebrew.cast("double"), letters.cast("double")))
    return F.struct(
        ratio.alias("ratio"),
        F.when(~none, hebrew).alias("hebrew_chars"),
        F.when(~none, letters).alias("total_alpha"),
        (~none & (ratio >= F.lit(limits.hebrew_ratio))).alias("passed"),
        F.when(blank, "empty text").when(letters == 0, "no alphabetic chars").alias("detail"),
    )


def weird_chars(t: Column, limits: Limits = Limits()) -> Column:
    n = count_of(t, f"[{WEIRD}]")
    at = F.filter(F.transform(F.split(t, ""), lambda c, i: F.struct(c.alias("char"), i.alias("position"))), lambda x: F.lit(WEIRD).contains(x.char) & (x.char != ""))
    found = F.when(n > 0, F.slice(at, 1, limits.listed)).otherwise(F.slice(at, 1, 0))
    return F.struct(n.alias("count"), (n <= limits.weird).alias("passed"), found.alias("found"))


def text_length(t: Column, pages: Column, limits: Limits = Limits()) -> Column:
    total = F.length(strip(t))
    mean = total.cast("double") / F.greatest(F.coalesce(pages, F.lit(1)), F.lit(1))
    return F.struct(total.alias("total_chars"), mean.alias("avg_per_page"), pages.alias("num_pages"), mean.between(limits.page_min, limits.page_max).alias("passed"))


def spacing(t: Column, limits: Limits = Limits()) -> Column:
    double, triple = count_of(t, "  "), count_of(t, "   ")
    merged = F.size(F.filter(F.split(t, "\n"), lambda x: (F.length(x) > 30) & ~x.contains(" ")))
    score = double + triple * 2 + merged * 5
    return F.struct(double.alias("double_spaces"), triple.alias("triple_spaces"), merged.alias("merged_lines"), score.alias("error_score"), (score < limits.spacing).alias("passed"))


def final_letters(t: Column, limits: Limits = Limits()) -> Column:
    middle = count_of(t, f"[{FINAL}](?={HEBREW})")
    end = count_of(t, f"(?<={HEBREW})[{REGULAR}](?!{HEBREW})")
    errors = middle + end
    words = F.filter(F.regexp_extract_all(t, F.lit(f"({HEBREW}+)"), 1), lambda w: F.length(w) >= 2)

    def of_word(w: Column) -> Column:
        inner = F.transform(F.split(F.substring(w, F.lit(1), F.length(w) - 1), ""), lambda c: F.struct(w.alias("word"), F.lit("final_in_middle").alias("type"), c.alias("char"), F.translate(c, FINAL, REGULAR).alias("expected")))
        inner = F.filter(inner, lambda x: F.lit(FINAL).contains(x.char))
        last = F.substring(w, F.length(w), F.lit(1))
        tail = F.array(F.struct(w.alias("word"), F.lit("regular_at_end").alias("type"), last.alias("char"), F.translate(last, REGULAR, FINAL).alias("expected")))
        return F.concat(inner, F.filter(tail, lambda x: F.lit(REGULAR).contains(x.char)))

    details = F.slice(F.flatten(F.transform(words, of_word)), 1, limits.listed)
    return F.struct(errors.alias("errors"), (errors < limits.finals).alias("passed"), details.alias("details"), middle.alias("final_in_middle"), end.alias("regular_at_end"))


def nikud(t: Column, limits: Limits = Limits()) -> Column:
    double, stray = count_of(t, f"{NIKUD}{{2,}}"), count_of(t, f"(?<=[^{HEBREW[1:]}){NIKUD}")
    return F.struct(count_of(t, NIKUD).alias("nikud_count"), double.alias("double_nikud"), stray.alias("nikud_on_non_hebrew"), ((double < limits.double_nikud) & (stray < limits.stray_nikud)).alias("passed"))


def grammar(t: Column, limits: Limits = Limits()) -> Column:
    single = count_of(t, f"(?<!{HEBREW})[\\x{{590}}-\\x{{5ff}}&&[^{SINGLE}]](?!{HEBREW})")
    repeated = count_of(t, f"({HEBREW})\\1{{2,}}")
    return F.struct(single.alias("single_char_errors"), repeated.alias("repeated_chars"), ((single < limits.single) & (repeated < limits.repeated)).alias("passed"))


LEVEL_1 = ("hebrew_ratio", "weird_chars", "text_length", "spacing")
LEVEL_2 = ("final_letters", "nikud", "grammar")


def checked(df: DataFrame, text: str = "text", pages: str = "num_pages", limits: Limits = Limits()) -> DataFrame:
    """The input with a column for each of the seven checks."""
    t = text_of(F.col(text))
    return df.withColumns({
        "hebrew_ratio": hebrew_ratio(t, limits), "weird_chars": weird_chars(t, limits), "text_length": text_length(t, F.col(pages), limits), "spacing": spacing(t, limits),
        "final_letters": final_letters(t, limits), "nikud": nikud(t, limits), "grammar": grammar(t, limits),
    })


def score(limits: Limits = Limits()) -> Column:
    """0 to 100, of a frame with the checks."""

    def off(check: str, points: Column) -> Column:
        return F.when(F.col(f"{check}.passed"), 0).otherwise(points)

    ratio = F.round(F.col("hebrew_ratio.ratio"), 4)
    lost = (
        off("hebrew_ratio", ((F.lit(limits.hebrew_ratio) - ratio) * 100).cast("int"))
        + off("weird_chars", F.least(F.lit(15), F.col("weird_chars.count")))
        + off("text_length", F.lit(10))
        + off("spacing", F.least(F.lit(10), F.floor(F.col("spacing.error_score") / 5).cast("int")))
        + off("final_letters", F.least(F.lit(10), F.col("final_letters.errors")))
        + off("nikud", F.lit(5))
        + off("grammar", F.lit(5))
    )
    return F.greatest(F.lit(0), F.least(F.lit(100), 100 - lost)).cast("int")


def recommendation(points: Column) -> Column:
    return F.when(points >= 90, "excellent").when(points >= 75, "good").when(points >= 60, "needs_review").otherwise("poor_quality")


def scored(df: DataFrame, text: str = "text", pages: str = "num_pages", limits: Limits = Limits()) -> DataFrame:
    """The input with the checks, ``score`` and ``recommendation``."""
    return checked(df, text, pages, limits).withColumn("score", score(limits)).withColumn("recommendation", recommendation(F.col("score")))


def report(df: DataFrame, text: str = "text", pages: str = "num_pages", limits: Limits = Limits()) -> DataFrame:
    """The input's other columns with the nested ``quality_report``; ratios to four digits, lengths to whole characters."""
    kept = [c for c in df.columns if c != text]
    out = scored(df, text, pages, limits)
    ratio = F.struct(F.round("hebrew_ratio.ratio", 4).alias("ratio"), *(F.col(f"hebrew_ratio.{c}") for c in ("hebrew_chars", "total_alpha", "passed", "detail")))
    length = F.struct("text_length.total_chars", round_half_even(F.col("text_length.avg_per_page")).cast("long").alias("avg_per_page"), "text_length.num_pages", "text_length.passed")
    level1 = F.struct(ratio.alias("hebrew_ratio"), "weird_chars", length.alias("text_length"), "spacing")
    level2 = F.struct("final_letters", "nikud", "grammar")
    return out.select(*kept, F.struct(level1.alias("level1"), level2.alias("level2"), "score", "recommendation").alias("quality_report"))

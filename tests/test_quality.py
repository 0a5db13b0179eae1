import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.operators import quality

HEB = "אבגדהכלמנסףץך"


def restated(text, pages):
    """The rules once more, in plain Python."""
    n_heb = sum("֐" <= c <= "׿" for c in text)
    letters = sum(unicodedata.category(c)[0] == "L" for c in text)
    none = not text.strip() or not letters
    ratio = 0.0 if none else n_heb / letters
    weird = sum(c in quality.WEIRD for c in text)
    mean = len(text.strip()) / max(pages or 1, 1)
    spaces = len(re.findall("  ", text)) + 2 * len(re.findall("   ", text)) + 5 * sum(len(x) > 30 and " " not in x for x in text.split("\n"))
    ws = re.findall("[֐-׿]+", text)
    finals = sum(c in quality.FINAL for w in ws for c in w[:-1]) + sum(len(w) > 1 and w[-1] in quality.REGULAR for w in ws)
    points = "[ְ-ׇֽֿׁׂ]".replace("ׇ", "")
    double, stray = len(re.findall(points + "{2,}", text)), len(re.findall("[^֐-׿]" + points, text))
    single, thrice = sum(len(w) == 1 and w not in quality.SINGLE for w in ws), len(re.findall(r"([֐-׿])\1{2,}", text))
    off = 0 if not none and ratio >= 0.85 else int((0.85 - round(ratio, 4)) * 100)
    off += 0 if weird <= 10 else min(15, weird)
    off += 0 if 500 <= mean <= 5000 else 10
    off += 0 if spaces < 50 else min(10, spaces // 5)
    off += 0 if finals < 10 else min(10, finals)
    off += 0 if double < 5 and stray < 3 else 5
    off += 0 if single < 10 and thrice < 5 else 5
    return max(0, min(100, 100 - off)), finals, spaces, double, stray, single, thrice, weird


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from(HEB + "ab ְָ\n@■.x  "), max_size=400), st.sampled_from([None, 0, 1, 3])), min_size=30, max_size=60))
def test_against_the_rules_restated(spark, cases):
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(cases)], "id int, text string, num_pages int")
    for r in quality.scored(df).collect():
        want = restated(*cases[r.id])
        got = (r.score, r.final_letters.errors, r.spacing.error_score, r.nikud.double_nikud, r.nikud.nikud_on_non_hebrew, r.grammar.single_char_errors, r.grammar.repeated_chars, r.weird_chars["count"])
        assert got == want, cases[r.id]


EDGES = {
    "weird 10": ("א" * 600 + "@" * 10, "weird_chars", True), "weird 11": ("א" * 600 + "@" * 11, "weird_chars", False),
    "length 499": ("א" * 499, "text_length", False), "length 500": ("א" * 500, "text_length", True), "length 5000": ("א" * 5000, "text_length", True), "length 5001": ("א" * 5001, "text_length", False),
    "spacing 49": ("א  " * 49, "spacing", True), "spacing 50": ("א  " * 50, "spacing", False),
    "finals 9": ("אכ " * 9, "final_letters", True), "finals 10": ("אכ " * 10, "final_letters", False),
    "double 4": ("אְְ" * 4, "nikud", True), "double 5": ("אְְ" * 5, "nikud", False), "stray 2": ("xְ" * 2, "nikud", True), "stray 3": ("xְ" * 3, "nikud", False),
    "single 9": ("ג " * 9, "grammar", True), "single 10": ("ג " * 10, "grammar", False), "thrice 4": ("אאא " * 4, "grammar", True), "thrice 5": ("אאא " * 5, "grammar", False),
    "ratio .85": ("א" * 85 + "a" * 15, "hebrew_ratio", True), "ratio .84": ("א" * 84 + "a" * 16, "hebrew_ratio", False), "blank": (" \n", "hebrew_ratio", False), "null": (None, "hebrew_ratio", False), "no letters": ("12", "hebrew_ratio", False),
}


def test_every_limit(spark):
    names = list(EDGES)
    df = spark.createDataFrame([(i, EDGES[n][0], 1) for i, n in enumerate(names)], "id int, text string, num_pages int")
    for r in quality.checked(df).collect():
        text, check, passed = EDGES[names[r.id]]
        assert r[check].passed == passed, names[r.id]


def test_lists_are_capped_and_in_order(spark):
    df = spark.createDataFrame([(1, "a@" * 30 + " אכ" * 30, 1)], "id int, text string, num_pages int")
    r = quality.checked(df).collect()[0]
    assert [x.position for x in r.weird_chars.found] == list(range(1, 41, 2)) and len(r.final_letters.details) == 20
    assert r.final_letters.details[0].asDict() == {"word": "אכ", "type": "regular_at_end", "char": "כ", "expected": "ך"}


@pytest.mark.parametrize("points,want", [(100, "excellent"), (90, "excellent"), (89, "good"), (75, "good"), (74, "needs_review"), (60, "needs_review"), (59, "poor_quality"), (0, "poor_quality")])
def test_recommendations(spark, points, want):
    df = spark.createDataFrame([(points,)], "score int")
    assert df.select(quality.recommendation(df.score)).first()[0] == want


def test_no_rows_and_extra_columns(spark):
    df = spark.createDataFrame([], "id int, text string, num_pages int, score_before int")
    assert quality.report(df).columns == ["id", "num_pages", "score_before", "quality_report"] and quality.report(df).count() == 0

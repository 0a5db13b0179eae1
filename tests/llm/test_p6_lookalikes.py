import unicodedata

import pytest

import __spark_entry__ as e
from quire.llm import lookalikes
from tests.llm.fixtures import common, labels, pages, words

DATA = "/root/testdata/sf0.001"
FORMS = lookalikes.Forms({})
CASES = {
    "ｃｏｖｉｒｍ": "covirm", "２０": "20", "ﬁn": "fin", "ﬆ": "st", "ﬡﬥ": "אל", "ﭏ": "אל", "ﻻ": "لا", "ﺑ": "ب", "⼈": "人", "ｶﾞ": "ガ", "ﾝ": "ン", "ℵב": "אב",
    "а cоmmunity": "а community", "кpенай": "кренай", "übеr": "über", "fοflitrim": "foflitrim", "нyвяcть": "нувясть",
    "école": "école", "שׁ": "שׁ", "מּ": "מּ", "שָׁ": "שָׁ", "a​b⁠c﻿": "abc", "‏א‎": "א", "a b c　d": "a b c d", "a­b": "ab",
}
SAME = ["", "plain text", "сос coc", "½ ² ³ № × ° …", "“typographic” – «quotes» „x“", "，。！？「」", "Слово word", "T3河", "tab\there", "שָׁלוֹם", "ไทย ทำ", "한국어", "café naïve Ångström", "µm"[1:]]


@pytest.mark.parametrize("text", CASES)
def test_rewritten(text):
    got = FORMS.line(text)
    assert got == unicodedata.normalize("NFC", CASES[text]) and FORMS.line(got) == got


@pytest.mark.parametrize("text", SAME)
def test_left_alone(text):
    text = unicodedata.normalize("NFC", text)
    assert FORMS.line(text) == text


def test_classes_are_transitive():
    u = lookalikes.UnionFind()
    for a, b in ("ab", "cd", "bd", "xy"):
        u.join(a, b)
    assert u.find("a") == u.find("c") != u.find("x") and u.find("z") == "z"


def test_frequency_decides_between_scripts():
    latin, cyrillic = lookalikes.Forms({"a": 9, "c": 9, "o": 9}), lookalikes.Forms({"а": 9, "с": 9, "о": 9})
    assert latin.line("cоa") == "coa"  # most letters are of one script
    assert latin.line("cо") == "co" and cyrillic.line("cо") == "со"  # as many of either: the corpus decides


def test_lines_and_junk(spark):
    rows = [(1, "1", 1, "plain\nﬁne\n\nx y"), (1, "1", 1, "plain\nﬁne\n\nx y"), (2, "1", 2, None), (3, "1", 3, ""), (4, "1", 4, "as it is")]
    args = (labels(spark), words(spark, ["plain"]), common(spark))
    assert {tuple(r) for r in lookalikes.found(pages(spark, rows), *args).collect()} == {(1, 1), (1, 3)}
    assert {r.page_id: r.text for r in lookalikes.rewritten(pages(spark, rows)).collect()} == {1: "plain\nfine\n\nx y", 2: None, 3: "", 4: "as it is"}
    assert lookalikes.found(pages(spark, []), *args).count() == 0


def test_all_texts_come_out_consistent(spark):
    rows = e.queries()["p6_text"](spark, DATA).collect()
    assert all(unicodedata.is_normalized("NFC", r.text) and not any(unicodedata.category(c) == "Cf" for c in r.text) for r in rows if r.text)

import pytest

import __spark_entry__ as e
from quire.llm import sentences
from tests.llm.fixtures import pages

DATA = "/root/testdata/sf0.001"
LINES = [
    "He met Dr. Zarcon at 7.30 p.m. sharp. “Shall we go?” said A. B. Tuvel. “No!” They left.",
    "It cost 3.50 (see p. 12). That is all, i.e. enough, etc. Next one... and so on.",
    "Er kam am 3. März z. B. spät. „Warum?“ sagte Hr. Pelgry. „So!“ Das war es.",
    "הוא אמר \"שלום?\", אמר המורה. ר' לבוני ח.ל. דוסקי בא. \"סוף.\" ועוד ד\"ר אחד.",
    "听到“有面包店！”的喊声就走了。“好吗？”他说No. 5很好。完",
    "旅は「橋、月？」と言った。「行く。」次の駅A. B. Kedrenまで。",
    "«ያ እና?»፣ ሰው አለ። ሌላ ዓ.ም. በኋላ። ሌላ፧",
    "डॉ. लबोनी पृ. 15 है। “क्या?”, उसने कहा। अंत",
    "Он жил на ул. Бердан в 1923 г. и т. д. «Да!» — сказал он. Нет.",
    "1. first item with 2.5 parts",
    "du la des est ........ 76",
    "an “open quote. Then more. End",
    "Никак с. Потом с. 5. Sí, no. No. 7 es. El al. Fin",
]
WANT = [
    ["He met Dr. Zarcon at 7.30 p.m. sharp.", "“Shall we go?” said A. B. Tuvel.", "“No!”", "They left."],
    ["It cost 3.50 (see p. 12).", "That is all, i.e. enough, etc.", "Next one... and so on."],
    ["Er kam am 3. März z. B. spät.", "„Warum?“ sagte Hr. Pelgry.", "„So!“", "Das war es."],
    ["הוא אמר \"שלום?\", אמר המורה.", "ר' לבוני ח.ל. דוסקי בא.", "\"סוף.\"", "ועוד ד\"ר אחד."],
    ["听到“有面包店！”的喊声就走了。", "“好吗？”", "他说No. 5很好。", "完"],
    ["旅は「橋、月？」と言った。", "「行く。」", "次の駅A. B. Kedrenまで。"],
    ["«ያ እና?»፣ ሰው አለ።", "ሌላ ዓ.ም. በኋላ።", "ሌላ፧"],
    ["डॉ. लबोनी पृ. 15 है।", "“क्या?”, उसने कहा।", "अंत"],
    ["Он жил на ул. Бердан в 1923 г. и т. д. «Да!» — сказал он.", "Нет."],
    ["1. first item with 2.5 parts"],
    ["du la des est ........ 76"],
    ["an “open quote.", "Then more.", "End"],
    ["Никак с.", "Потом с. 5.", "Sí, no.", "No. 7 es.", "El al.", "Fin"],
]


@pytest.mark.parametrize("line,want", list(zip(LINES, WANT)))
def test_lines(line, want):
    got = [line[a:b] for a, b in sentences.Splitter().units(line)]
    if line.startswith("Он"):  # a quotation after "and so on" may open a sentence of its own
        assert got in (want, [want[0][: want[0].index("«") - 1], want[0][want[0].index("«") :], want[1]])
    else:
        assert got == want


def test_offsets_blank_lines_and_nothing():
    s = sentences.Splitter()
    assert list(s.units(None)) == list(s.units("")) == list(s.units(" \n\t\n")) == []
    text = "  Ab. Cd. \n\n  e "
    assert [text[a:b] for a, b in s.units(text)] == ["Ab.", "Cd.", "e"]


def test_doubtful_signs_follow_the_counts():
    s = sentences.Splitter({("ellipsis", 7, 7): (20, 20), ("ellipsis", 9, 9): (0, 20)})
    one = lambda n: " ".join(["מלה"] * n)
    assert len(list(s.units(f"{one(7)}... {one(7)}."))) == 1 and len(list(s.units(f"{one(9)}... {one(9)}."))) == 2


def test_units_cover_every_page(spark):
    rows = e.queries()["p4_found"](spark, DATA)
    assert rows.dtypes == [("page_id", "bigint"), ("end_pos", "int")]
    got = {tuple(r) for r in rows.collect()}
    assert len(got) == rows.count()
    texts = {r.page_id: r.text for r in spark.read.parquet(f"{DATA}/pages.parquet").where("stage = 'proofed'").collect()}
    for k, text in texts.items():
        at, ends = 0, {b for a, b in got if a == k}
        for line in (text or "").split("\n"):
            if line.strip():
                assert at + len(line.rstrip()) in ends
            at += len(line) + 1
        assert all(0 < b <= len(text) and not text[b - 1].isspace() for b in ends)
    assert {r.page_id for r in e.queries()["p4_units"](spark, DATA).collect()} >= {a for a, _ in got}


def test_tables_with_nothing(spark):
    assert sentences.found(pages(spark, [], "proofed")).count() == 0
    assert sentences.found(pages(spark, [(1, "1", 1, None), (2, "1", 1, "")], "proofed")).count() == 0


def test_a_very_long_line(spark):
    text = "One two three. " * 20_000
    assert sentences.found(pages(spark, [(1, "1", 1, text)], "proofed")).count() == 20_000

from pyspark.sql import functions as F

from quire.operators import dictionary as d


def words(spark, *ws):
    return spark.createDataFrame([(w,) for w in ws], "word string")


def test_known_with_prefixes(spark):
    own = words(spark, "בית", "ילד", " שם ", "", None, "בית")
    got = {r.word for r in d.known(words(spark, "בית", "הבית", "שלבית", "לשם", "הילד", "של", "בשל", None), own).collect()}
    assert got == {"בית", "הבית", "שלבית", "לשם", "הילד"}
    assert d.has_dictionary(own) and not d.has_dictionary(words(spark, "", None))


def test_closest_has_one_edit_and_the_least_word(spark):
    own = words(spark, "abcd", "abcx", "bcd", "abde", "zzzz")
    got = {r.word: r.suggestion for r in d.closest(words(spark, "abce", "abcd", "qqqq", "zzz", "badc"), own).collect()}
    assert got == {"abce": "abcd", "abcd": "abcx", "zzz": "zzzz"}


def test_check(spark):
    texts = spark.createDataFrame([(1, "בית ילד xx בֵית כלד"), (2, None), (3, "")], "id int, text string")
    got = {r.id: r for r in d.check(texts, words(spark, "בית", "ילד"), "id").collect()}
    assert (got[1].total_words, got[1].unknown_words, got[1].unknown_list) == (4, 2, ["בֵית", "כלד"])
    assert [s.suggestion for s in got[1].suggestions] == ["בית", "ילד"] and got[1].accuracy == 0.5
    assert got[2].total_words == 0 and got[2].accuracy == 0.0 and got[3].unknown_list == []


def test_tokens_are_the_text(spark):
    texts = [" a  b c\n", "x", "", "\t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(d.tokens(F.col("t")).alias("x"))
    assert ["".join(r.x) for r in df.collect()] == texts


def test_flags(spark):
    df = spark.createDataFrame([('אמר כמש"כ, וכן (נ"מ) כמש"כx',)], "t string")
    assert df.select(d.flag_ambiguous(F.col("t"))).first()[0] == 'אמר ⚠️כמש"כ,⚠️ וכן ⚠️(נ"מ)⚠️ כמש"כx'


ROW = "doc_id string, page_number int, word_idx int, text string, symbol_confidences array<struct<char:string,confidence:double>>"


def signs(text, **low):
    return [(c, low.get(f"at{i}", 0.99)) for i, c in enumerate(text)]


def test_flags_by_confidence(spark):
    rows = [("1", 1, 0, 'כ"מ', signs('כ"מ')), ("1", 1, 1, 'ב"נ', signs('ב"נ', at2=0.5)), ("1", 1, 2, 'נ"מ', None), ("1", 1, 3, "של", None), ("1", 1, 4, 'כ"מ', signs('כ"מ', at0=0.9))]
    got = {r.word_idx: r.flagged for r in d.flag_words(spark.createDataFrame(rows, ROW), ["doc_id", "page_number"]).collect()}
    assert got == {0: True, 1: True, 2: True, 4: True}  # the last word of a text lends its confidences
    got = {r.word_idx: r.flagged for r in d.flag_words(spark.createDataFrame(rows[:2], ROW), ["doc_id", "page_number"]).collect()}
    assert got == {0: False, 1: True}


def test_fixes(spark):
    own = words(spark, "נר", "כד", "כר")
    rows = [("1", 1, 0, "'בר'", None), ("1", 1, 1, "נד", None), ("1", 1, 2, "נד", signs("נד", at0=0.5)), ("1", 1, 3, "נד", signs("נד", at0=0.9)), ("1", 1, 4, 'כמש"כ', None), ("1", 1, 5, None, None), ("1", 1, 6, "כד", None)]
    got = {r.word_idx: r.fixed for r in d.fix_words(spark.createDataFrame(rows, ROW), own, ["doc_id", "page_number"]).collect()}
    assert got == {0: "'כר'", 1: "נד", 2: "כד", 3: "נד", 4: 'כמש"כ', 5: None, 6: "כד"}
    texts = spark.createDataFrame([(1, "אז  'בר' נד\n"), (2, None)], "id int, text string")
    assert dict(d.fix_texts(texts, own, "id").collect()) == {1: "אז  'כר' נד\n", 2: ""}

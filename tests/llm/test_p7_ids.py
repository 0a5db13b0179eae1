import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as e

DATA = "/root/testdata/sf0.001"


def test_every_document_has_the_ids_of_the_public_tokenizer(spark):
    peer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    peer.encode_special_tokens = True
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = e.queries()["p7_ids"](spark, DATA)
    assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    rows = got.collect()
    assert len(rows) == len(texts)
    assert {r.doc_id: r.ids for r in rows} == {k: peer.encode(t or "", add_special_tokens=False).ids for k, t in texts.items()}


def test_null_empty_and_odd_texts(spark, tmp_path):
    peer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    peer.encode_special_tokens = True
    texts = [None, "", " \n\t ", "<|endoftext|>", "it's 12½ x²", "a" * 3000, "😀‏שָׁלוֹם ", "x  \n\n y\r\n"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = dict(e.queries()["p7_ids"](spark, str(tmp_path)).collect())
    assert rows == {i: peer.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}


def test_entry_returns_rows(spark):
    assert e.entry(spark).count() > 0

import public_tokenizers
import pytest

from quire.llm.tokens import PerfectHash, vocabulary


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_every_key_has_its_id_and_strangers_none(name):
    ids = vocabulary(public_tokenizers.path(name))
    table = PerfectHash(ids)
    assert all(table.get(k) == v for k, v in ids.items())
    assert all(table.get(k + b"\xff\xfe~") is None for k in list(ids)[:2000])


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 5000, 20000, 50255])
def test_other_sizes(n):
    ids = dict(list(vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")).items())[:n])
    table = PerfectHash(ids)
    assert all(table.get(k) == v for k, v in ids.items()) and table.get(b"\xff\xfe~") is None

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldloom.llm import sentencepiece_codec
from fieldloom.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.MergeCodec(tokenizer_file())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abethin ▁\nÀ日😀Ａ\x00", max_size=80))
def test_same_as_the_library(text):
    own = sentencepiece_codec.codec(tokenizer_file())
    (ids,) = own.encode([text])
    assert ids == own.library.encode(text, add_eos=True)
    assert own.decode(ids) == own.library.decode(ids)


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b ", "a" * 5000, " " * 999, "▁" * 40 + "x", "ab" * 3000 + " " * 50 + "é" * 1000, "<s> </s> <0x41>"])
def test_long_and_odd_texts(codec, text):
    assert codec.encode([text]) == [codec.library.encode(text, add_eos=True)]


def test_memory_may_be_small(codec, monkeypatch, docs):
    """What a worker remembers changes nothing but its speed."""
    monkeypatch.setattr(sentencepiece_codec, "REMEMBERED_BYTES", 10_000)
    own = sentencepiece_codec.MergeCodec(tokenizer_file())
    for r in docs.limit(40).collect():
        assert own.encode([r.text]) == [own.library.encode(r.text, add_eos=True)]


def test_round_trip(codec, docs, odd, none):
    for df in (docs, odd):
        texts = {}
        for r in df.collect():
            texts.setdefault(r.doc_id, set()).add(r.text or "")
        rows = sentencepiece_codec.round_trip(df, tokenizer_file()).collect()
        assert len(rows) == df.count()
        for r in rows:
            wanted = set()
            for t in texts[r.doc_id]:
                ids = codec.library.encode(t, add_eos=True)
                wanted.add((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(codec.library.decode(ids).encode()).hexdigest()))
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in wanted
    assert sentencepiece_codec.round_trip(none, tokenizer_file()).count() == 0
    kept = sentencepiece_codec.round_trip(odd.filter("doc_id = 9"), tokenizer_file(), keep_ids=True).first()
    assert codec.library.decode(kept.ids) == kept.decoded

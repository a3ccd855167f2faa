import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adloom.llm import tokens

tokenizers = pytest.importorskip("tokenizers")
if not os.path.exists(f"{tokens.TOKENIZERS}/byte_bpe_50k.json"):
    pytest.skip("no vocabulary files", allow_module_level=True)
ENC = tokens.Encoder(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken")
REF = tokenizers.Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
REF.encode_special_tokens = True


def _ref(text):
    return REF.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("abcděř 0123'’\n<|endoftext|>", max_size=60))
def test_equals_the_public_tokenizer(text):
    assert ENC.encode([text]) == [_ref(text)]


def test_corpus(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " ", "x"), (4, "<|endoftext|>", "x"), (5, "a" * 30_000, "x"), (6, "Žluťoučký kůň", "x"), (7, "Žluťoučký kůň", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_corpus(df).collect()}
    assert got == {i: _ref(t) if t else [] for i, t, _ in rows}
    assert tokens.encode_corpus(df.limit(0)).count() == 0


def test_failing_words_are_merged():
    words = ["zzxqj", "ěščřžýáíé", "aaaaaaaab", "́́"]
    assert ENC.encode_words(words) == [_ref(w) for w in words]


def test_pairs_stay_bounded(monkeypatch):
    enc = tokens.Encoder(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken")
    monkeypatch.setattr(tokens, "PAIRS", 10)
    for text in ("straightforwardness unbelievably", "counterintuitively", "zzxqj ěščřžýáíé", "misinterpretation"):
        assert enc.encode([text]) == [_ref(text)]
    assert len(enc.keys) < 40


def test_a_vocabulary_without_a_byte_is_refused(tmp_path):
    (tmp_path / "x.tiktoken").write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        tokens.Encoder(str(tmp_path / "x.tiktoken"))

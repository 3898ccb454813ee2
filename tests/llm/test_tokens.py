import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelops.llm.tokens import ChunkEncoder

ODD = ["", " ", "a  b", "  a", " a b ", "x\n y", "a\n\nb c", "é  x \n", "<|endoftext|> x", "a\t b",
       "don't we'll  ", "a\x85 b c", "ΑΣ ΣΑ Σ", "a 's b", "1 2  3", ".. ..", "日本 語", "of%%% the&&& a,",
       "\0 a b", "x" * 3000]


@pytest.fixture(scope="module", params=[("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def enc(request):
    name, keeps = request.param
    return ChunkEncoder(public_tokenizers.path(name), keeps)


def test_chunks_equal_whole_texts(enc, small_docs):
    for text in [*ODD, *[t for _, t, _ in small_docs]]:
        assert enc.ids(text).tolist() == enc.whole(text).tolist(), text[:80]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("ab .,'\n\t!%1é\u0301\u00a0\u3000Σ|<>")), max_size=24))
def test_chunks_equal_whole_for_any_text(enc, text):
    assert enc.ids(text).tolist() == enc.whole(text).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(min_codepoint=32, max_codepoint=255) | st.sampled_from(" \n\u0301"), max_size=24))
def test_plain_texts_equal_whole(enc, text):
    assert enc.ids(text).tolist() == enc.whole(text).tolist()


def test_plain_chunks_are_merged_by_the_model_alone(enc, monkeypatch):
    """New chunks of plain characters do not pay for the whole tokenizer."""
    text = "Thenblend edouen,\nÈment l\u00e9tre *** thh| 4807 x/y (Qu) $$$ d'eau Σα."
    expected = enc.whole(text).tolist()
    sent = []

    class Counted:
        def __init__(self, tok):
            self.tok = tok

        def encode_batch_fast(self, texts, **kw):
            sent.extend(texts)
            return self.tok.encode_batch_fast(texts, **kw)

    enc.cache.clear()
    monkeypatch.setattr(enc, "tok", Counted(enc.tok))
    assert enc.ids(text).tolist() == expected
    assert {c.strip() for c in sent} <= {"", "d'eau", "Σα."}

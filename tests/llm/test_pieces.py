"""SentencePiece encoding by a table of distinct words."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from panelops.llm import sentence_pieces
from panelops.llm.queries import QUERIES

from .conftest import SMALL, rows_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def expected(text):
    lib = sentence_pieces.processor(MODEL)
    ids = lib.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" ▁ab\n\té漢\0.\U0001f600<s>"), max_size=40))
def test_ids_of_words_are_the_ids_of_the_text(text):
    words = sentence_pieces.marked_words(pa.array([text], pa.large_string()))[0].as_py()
    ids = [i for w in sentence_pieces.segment_words(MODEL, words) for i in w]
    assert ids == sentence_pieces.processor(MODEL).encode(text)


def test_query_agrees_with_the_library(spark, small_docs):
    got = rows_of(QUERIES["op11_sentence_pieces"](spark, SMALL))
    assert len(got) == len(small_docs)
    by_id = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got}
    assert by_id == {i: expected(t) for i, t, _ in small_docs}


@pytest.mark.parametrize("block_chars", [1, 100, 8_000_000])
def test_odd_rows(spark, odd, block_chars):
    lib = sentence_pieces.processor(MODEL)
    want = Counter((r["doc_id"], tuple(lib.encode(r["text"] or ""))) for r in rows_of(odd))
    encoded = sentence_pieces.encode(odd, MODEL, block_chars)
    assert encoded.columns == ["doc_id", "ids"]
    rows = rows_of(sentence_pieces.decode(encoded, MODEL))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == want
    assert Counter(r["decoded"] for r in rows) == Counter(r["text"] or "" for r in rows_of(odd))


def test_words_are_segmented_once(monkeypatch):
    asked = Counter()
    real = sentence_pieces.segment_words

    def counted(model, words):
        asked.update(words)
        return real(model, words)

    monkeypatch.setattr(sentence_pieces, "segment_words", counted)
    table = sentence_pieces.WordTable(MODEL)
    lib = sentence_pieces.processor(MODEL)
    texts = ["a b a  b", "", "b a ", "c " * 50]
    for _ in range(2):
        ids = sentence_pieces.encode_block(pa.array(texts, pa.large_string()), table)
        assert ids.to_pylist() == [lib.encode(t) for t in texts]
    assert set(asked) == {"a", "b", " b", "c", ""} and set(asked.values()) == {1}
    small = sentence_pieces.WordTable(MODEL, max_kept=2)
    ids = sentence_pieces.encode_block(pa.array(texts, pa.large_string()), small)
    assert ids.to_pylist() == [lib.encode(t) for t in texts]


def test_empty_table_and_empty_texts(spark, empty, odd):
    assert rows_of(sentence_pieces.encode(empty, MODEL)) == []
    only_empty = odd.where("text is null or text = ''")
    assert [r["ids"] for r in rows_of(sentence_pieces.encode(only_empty, MODEL))] == [[]] * 2


def test_model_that_crosses_markers_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.pieces[30_000].piece = "a▁b"
    path = tmp_path / "crossing.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="crosses"):
        sentence_pieces.check_model(str(path))

"""SentencePiece encoding by tables of distinct marked words.

A SentencePiece model turns every space into a marker and puts one marker in
front of a text. Where no piece has a marker behind another character, no
piece crosses from one *marked word* (a run of markers and the characters up
to the next marker) into the next, so a text's ids are the ids of its marked
words, one after the other, and equal words have equal ids.

Each task takes its documents in blocks of about ``block_chars`` characters:

1. the block's texts are cut to marked words, and these to a table of the
   distinct ones and the number of every word in it;
2. each distinct word that the task has not met is segmented, once, by the
   library; what is known is kept for the task's next blocks;
3. the ids of every document are gathered by the word numbers, that is by
   position.

Nothing is shuffled or written: one table for the whole corpus was tried
first and needs more than twice the input on disk, because most distinct words
occur in one block only and each would travel to its table and back.
Memory of a task: one block, its table and at most ``MAX_KEPT`` kept words (a
text longer than a block is a block of its own).

``decode`` hands each document's ids to the library's ``decode``.

Defined cases: a null or empty text has no ids and decodes to the empty
string; a null doc_id is kept; repeated rows give a row each; very long texts
are encoded whole; an empty table gives no rows; other columns are ignored,
whatever their names. Rows of one doc_id need not be equal (ties), each is
encoded by itself.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"  # fixed value: SentencePiece's marker for a space
BLOCK_CHARS = 4_000_000
MAX_KEPT = 600_000  # about 100 MB in a worker

_MODELS: dict = {}


def processor(path: str):
    """The model, loaded once per worker."""
    import sentencepiece

    if path not in _MODELS:
        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def check_model(path: str) -> None:
    """Raise unless ids of marked words are the ids of the text."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules = model.normalizer_spec
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
        raise ValueError("the model changes texts before it segments them")
    if not (rules.add_dummy_prefix and rules.escape_whitespaces):
        raise ValueError("the model does not mark the first word")
    if model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model marks the ends of words")
    names = [p.piece for p in model.pieces]
    if MARK not in names or any(MARK in p.lstrip(MARK) for p in names):
        raise ValueError("a piece of the model crosses a whitespace marker")


def marked_words(texts: pa.Array) -> pa.Array:
    """List of the marked words of every text, each without its first marker
    and with a space for every other one; no words for an empty text.

    A border is a space that follows another character than a space.
    """
    plain = pc.replace_substring(texts, MARK, " ")
    # No marker is left in the texts, so it can stand for the borders.
    marked = pc.replace_substring_regex(plain, r"((?s:[^ ])) ", r"\1" + MARK)
    words = pc.split_pattern(marked, MARK)
    empty = pc.equal(plain, "")
    if not pc.any(empty).as_py():
        return words
    return pc.if_else(empty, pa.scalar([], words.type), words)


def segment_words(model_path: str, words: list[str]) -> list[list[int]]:
    """Ids of marked words given without their first marker."""
    model = processor(model_path)
    alone = [model.piece_to_id(MARK)]  # the library gives an empty text no marker
    return [ids if w else alone for w, ids in zip(words, model.encode(words, num_threads=1), strict=True)]


class WordTable:
    """Ids (u32 bytes) of the marked words that a task has met."""

    def __init__(self, model: str, max_kept: int = MAX_KEPT):
        self.model, self.max_kept = model, max_kept
        self.known: dict[str, bytes] = {}

    def ids_of(self, words: list[str]) -> list[bytes]:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.max_kept:
            known.clear()
            new = words
        for at in range(0, len(new), 50_000):
            some = new[at : at + 50_000]
            found = segment_words(self.model, some)
            known.update(zip(some, (array("I", i).tobytes() for i in found), strict=True))
        return [known[w] for w in words]


def encode_block(texts: pa.Array, table: WordTable) -> pa.ListArray:
    """Ids of every text (no nulls)."""
    lists = marked_words(texts)
    coded = pc.dictionary_encode(lists.flatten())
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    ids = table.ids_of(coded.dictionary.to_pylist())
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
    starts = np.cumsum(sizes) - sizes
    counts = sizes[numbers]
    before = np.concatenate([[0], np.cumsum(counts)])
    places = np.repeat(starts[numbers] - before[:-1], counts) + np.arange(before[-1])
    words = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    bounds = before[np.concatenate([[0], np.cumsum(words)])]
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat[places]))


def blocks_of(texts: pa.Array, block_chars: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of whole texts of about ``block_chars``."""
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = done = 0
    while start < len(texts):
        stop = max(int(np.searchsorted(ends, done + block_chars, side="right")), start + 1)
        yield start, stop
        start, done = stop, int(ends[stop - 1])


def encode(
    docs: DataFrame, model: str, block_chars: int = BLOCK_CHARS, max_kept: int = MAX_KEPT
) -> DataFrame:
    """doc_id and ids (array of int) of every row of ``docs`` (doc_id, text)."""
    check_model(model)
    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(model, max_kept)
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            for start, stop in blocks_of(texts, block_chars):
                ids = encode_block(texts.slice(start, stop - start), table)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), ids], names=schema.names
                )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Add ``decoded``, the library's text of ``ids``, to (doc_id, ids)."""
    schema = T.StructType(
        [encoded.schema["doc_id"], encoded.schema["ids"], T.StructField("decoded", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = processor(model)
        for batch in batches:
            if not len(batch):
                continue
            lists = batch.column(1)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            ids = np.split(lists.flatten().to_numpy(zero_copy_only=False), ends[:-1])
            texts = [lib.decode(i.tolist()) if len(i) else "" for i in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=schema.names
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)

"""Packing documents into fixed-length training sequences, best fit.

Tokenized documents longer than a sequence are cut into full pieces, the
first piece taking the remainder, so at most one piece of a document is
shorter than a sequence. Pieces are packed by bounded-space best fit: a fixed
number of bins is open; a bitset has one bit per amount of free space for
which a bin is open, so the tightest bin that still fits is one shift and one
lowest-set-bit away; when all bins are open and none fits, the fullest one is
closed. Closed bins are never looked at again, so memory is one number pair
per open bin.

Documents are dealt by key hash to groups of about ``group_docs`` documents,
and each group is packed by itself, online: pieces are placed in the order in
which they arrive, which is that of a hash of their document, and none waits
for a later one. ``open_bins`` is far below the bins that such a group would
hold open otherwise, so the fullest does close (README has the bins that
costs). No text and no ids are shuffled, only one small row per piece.

Defined cases: a null or empty text is one piece with the end id alone; a null
doc_id is a document like others; repeated rows are packed as often as they
occur (``copy`` numbers them), equal ones in the order of that number; extra
columns are ignored; an empty table gives no rows. A text of any length is one
document; its pieces are rows, not one value. ``docs`` has to come from a
written table: rows are numbered as they are read, and a lost executor must
find them in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.llm.tokens import MAX_CACHED

SEQUENCE_TOKENS = 1024
END_ID = 2
OPEN_BINS = 256
GROUP_DOCS = 8192

PIECE = "doc_id bigint, copy bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECE + ", sequence_id bigint, offset bigint"


class OpenBins:
    """At most ``limit`` open bins of ``size`` tokens, found by free space."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.bits = 0  # bit f: a bin with free space f is open
        self.n_open = 0
        self.n_bins = 0
        self.n_closed = 0  # bins closed with space left

    def _pop(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of ``length`` tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1  # tightest
            b = self._pop(free)
        else:
            if self.n_open >= self.limit:
                self._pop((self.bits & -self.bits).bit_length() - 1)  # fullest closes
                self.n_closed += 1
            b, free = self.n_bins, self.size
            self.n_bins += 1
        left = free - length
        if left:
            self.by_free[left].append(b)
            self.bits |= 1 << left
            self.n_open += 1
        return b, self.size - free


def cut_pieces(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % size or size
    return [(0, first), *[(s, size) for s in range(first, n, size)]]


def pieces(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    max_cached: int = MAX_CACHED,
) -> DataFrame:
    """One row per piece of every document (``docs``: doc_id, text, copy)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        from panelops.llm.tokens import encoder

        enc = encoder(tokenizer, True, max_cached)
        for batch in batches:
            doc, copy, text = (batch.column(i).to_pylist() for i in range(3))
            out: list[tuple] = []
            for d, c, t in zip(doc, copy, text, strict=True):
                ids = np.append(enc.ids(t or ""), np.uint32(end_id)).astype("<u4")
                for k, (s, n) in enumerate(cut_pieces(len(ids), size)):
                    out.append((d, c, k, s, n, crc32(ids[s : s + n])))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(cols, types, strict=True)],
                names=["doc_id", "copy", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "copy", "text").mapInArrow(run, PIECE)


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
    group_docs: int = GROUP_DOCS,
    max_cached: int = MAX_CACHED,
) -> DataFrame:
    """Place every piece of every document (needs doc_id and text).

    Returns doc_id, copy, piece, start, length, ids_crc32, sequence_id,
    offset. ``sequence_id`` is the group in the high 32 bits and the bin in
    the low ones. ``max_cached`` bounds the chunks a worker remembers (about
    230 bytes each); it changes speed and memory only.
    """
    # One count of rows (Parquet footers alone answer it).
    groups = max(1, -(-docs.count() // group_docs))
    copy = F.monotonically_increasing_id()
    numbered = docs.select("doc_id", "text", copy.alias("copy"))
    rows = pieces(numbered, tokenizer, size, end_id, max_cached)
    group = F.pmod(F.xxhash64("doc_id", "copy"), F.lit(groups)).alias("_g")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_at", "doc_id", "copy", "piece"])
        bins = OpenBins(size, open_bins)
        placed = [bins.place(n) for n in pdf["length"].tolist()]
        at = np.array(placed, dtype=np.int64).reshape(-1, 2)
        pdf["sequence_id"] = (np.int64(key[0]) << 32) + at[:, 0]
        pdf["offset"] = at[:, 1]
        return pdf.drop(columns=["_g", "_at"])

    # The order of arrival: another hash than the one that makes the groups.
    arrival = F.xxhash64(F.lit(1), "doc_id", "copy").alias("_at")
    return rows.select("*", group, arrival).groupBy("_g").applyInPandas(run, PACKED)

"""Token-id files with Elias-Fano document boundaries.

A segment holds the ids of consecutive documents (ascending doc_id) as one
array, and the running document ends as an Elias-Fano sequence: of each of
the n values up to u, the low ``l = floor(log2(u / n))`` bits are stored as
they are, and the high bits in unary as a bit vector with n ones, where
``select1(i) - i`` is the high part of value i. Together about ``2 + l`` bits
a document instead of 64. Select is answered from a directory, stored with the
segment, of one counter per 512-bit block, and a scan of that block: a
document's bounds need its block, its low bits and a search in the directory.

Segment layout, little-endian (fixed format):

    magic "EFT2" | u8 id bytes (2 or 4) | u8 low bits | u16 zero
    u64 n documents | u64 n ids | u64 documents with a null id (they are first)
    u64 bytes of low bits, high bits, directory, doc_ids
    low bits, packed | high bits, packed   (each padded to 8 bytes)
    directory: ones before each 512-bit block of the high bits, u32
    doc_ids: differences modulo 2^64 as LEB128, the first from 0
    ids

On a cluster, tasks can only write through Spark, so a segment is one binary
value of a Parquet row (segment keys: ``part``, ``seq``); every segment is
bounded by ``max_ids`` (a longer document is a segment of its own).

Order: texts are encoded where they are read, and only ids are moved: rows are
range-partitioned by (doc_id, hash of the text), so that an id which many rows
share is many ranges too; each range writes its segments in order, and a
prefix sum over ranges (one row per range) and over the segments of each range
gives every segment's first position, so ``start`` is global without a
single-task sort.

Defined cases: a null text is an empty one, with the end id alone; rows of one
doc_id are written in the order of their text's hash, equal rows as often as
they occur; null ids come first and are read back as null; an empty table
gives no rows; texts of any length are one document; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelops.session import cut_lineage, ensure_checkpoint_dir

MAGIC = b"EFT2"
MAX_IDS = 2_000_000
BLOCK = 512  # bits per select block


def _pack_bits(bits: np.ndarray) -> bytes:
    raw = np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()
    return raw + b"\0" * (-len(raw) % 8)


class EliasFano:
    """Monotone sequence of non-negative integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, before: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.before = before
        self._at = -1  # the block whose ones were looked up last

    @classmethod
    def encode(cls, values: np.ndarray, upper: int) -> EliasFano:
        """``values``: ascending int64, none above ``upper``."""
        n = len(values)
        low_bits = max(0, (upper // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.int64)
        low = ((values[:, None] >> shifts) & 1).ravel()
        ones = (values >> low_bits) + np.arange(n)
        high = np.zeros((upper >> low_bits) + n + 1, np.uint8)
        high[ones] = 1
        pad = -len(high) % BLOCK
        per_block = np.pad(high, (0, pad)).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
        before = (np.cumsum(per_block) - per_block).astype("<u4")
        return cls(n, low_bits, _pack_bits(low), _pack_bits(high), before)

    def select1(self, i: int) -> int:
        """Position of the i-th one (from 0) of the high bits."""
        b = int(np.searchsorted(self.before, i, side="right")) - 1
        block = np.frombuffer(self.high, np.uint8)[b * BLOCK // 8 : (b + 1) * BLOCK // 8]
        if b != self._at:  # documents are often read in order
            self._ones = np.flatnonzero(np.unpackbits(block, bitorder="little"))
            self._at = b
        return b * BLOCK + int(self._ones[i - int(self.before[b])])

    def __getitem__(self, i: int) -> int:
        high = self.select1(i) - i
        low, at = 0, i * self.low_bits
        if self.low_bits:
            first, last = at // 8, (at + self.low_bits + 7) // 8
            chunk = int.from_bytes(self.low[first:last], "little") >> (at % 8)
            low = chunk & ((1 << self.low_bits) - 1)
        return (high << self.low_bits) | low

    def all(self) -> np.ndarray:
        """Every value in one pass over the bits."""
        ones = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(ones)[: self.n] - np.arange(self.n)
        low = np.zeros(self.n, np.int64)
        if self.low_bits:
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
            bits = bits[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
            low = (bits << np.arange(self.low_bits)).sum(axis=1)
        return (high.astype(np.int64) << self.low_bits) | low


def _leb128(values: list[int]) -> bytes:
    out = bytearray()
    for v in values:
        while v > 127:
            out.append(v & 127 | 128)
            v >>= 7
        out.append(v)
    return bytes(out)


def _unleb128(raw: bytes) -> list[int]:
    out, v, shift = [], 0, 0
    for byte in raw:
        v |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            out.append(v)
            v = shift = 0
    return out


def encode_segment(doc_ids: list[int | None], arrays: list[np.ndarray]) -> bytes:
    """One segment; ``doc_ids`` ascending, nulls first."""
    ends = np.cumsum([len(a) for a in arrays], dtype=np.int64)
    ids = np.concatenate(arrays) if arrays else np.empty(0, np.uint32)
    wide = 4 if len(ids) and int(ids.max()) > 0xFFFF else 2
    ef = EliasFano.encode(ends, int(ends[-1]) if len(ends) else 0)
    known = [d for d in doc_ids if d is not None]
    keys = _leb128([(b - a) % (1 << 64) for a, b in zip([0, *known], known, strict=False)])
    directory = ef.before.tobytes()
    head = MAGIC + struct.pack(
        "<BBHQQQ", wide, ef.low_bits, 0, len(arrays), len(ids), len(doc_ids) - len(known)
    )
    sizes = struct.pack("<QQQQ", len(ef.low), len(ef.high), len(directory), len(keys))
    return b"".join(
        [head, sizes, ef.low, ef.high, directory, keys,
         ids.astype("<u2" if wide == 2 else "<u4").tobytes()]
    )


class Segment:
    """Reader of one segment: ``doc_ids``, and ``[i]`` for a document's ids."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        wide, low_bits, _, n, n_ids, nulls = struct.unpack_from("<BBHQQQ", raw, 4)
        low, high, directory, keys = struct.unpack_from("<QQQQ", raw, 32)
        at = 64
        before = np.frombuffer(raw, "<u4", directory // 4, at + low + high)
        self.ends = EliasFano(
            n, low_bits, raw[at : at + low], raw[at + low : at + low + high], before
        )
        at += low + high + directory
        # Sums modulo 2^64, then read as signed.
        known = np.cumsum(np.array(_unleb128(raw[at : at + keys]), np.uint64)).view(np.int64)
        self.doc_ids: list[int | None] = [None] * nulls + known.tolist()
        self.ids = np.frombuffer(raw, "<u2" if wide == 2 else "<u4", n_ids, at + keys)

    def __len__(self) -> int:
        return self.ends.n

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def __getitem__(self, i: int) -> np.ndarray:
        a, b = self.bounds(i)
        return self.ids[a:b]


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, keeps_space: bool) -> DataFrame:
    """(doc_id, h, wide, ids): ids of every text with its end id, as u16 bytes
    where all fit (``wide`` false), else u32; ``h`` is the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from panelops.llm.tokens import encoder

        enc = encoder(tokenizer, keeps_space)
        for batch in batches:
            wides, raws = [], []
            for t in batch.column(2).to_pylist():
                ids = np.append(enc.ids(t or ""), np.uint32(end_id))
                wides.append(int(ids.max()) > 0xFFFF)
                raws.append(ids.astype("<u4" if wides[-1] else "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(wides, pa.bool_()), pa.array(raws, pa.binary())],
                names=["doc_id", "h", "wide", "ids"],
            )

    hashed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    return hashed.mapInArrow(run, "doc_id long, h long, wide boolean, ids binary")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    keeps_space: bool = False,
    max_ids: int = MAX_IDS,
) -> None:
    """Encode every text (null: empty), append ``end_id`` and write segments
    in ascending doc_id order to ``path``. Needs doc_id and text.
    """
    schema = "seq long, n_docs long, n_ids long, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int | None] = []
        arrays: list[np.ndarray] = []
        held = seq = 0

        def flush() -> pa.RecordBatch:
            raw = encode_segment(keys, arrays)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([seq], pa.int64()), pa.array([len(keys)], pa.int64()),
                    pa.array([held], pa.int64()), pa.array([raw], pa.binary()),
                ],
                names=["seq", "n_docs", "n_ids", "payload"],
            )

        for batch in batches:
            for d, wide, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(raw, "<u4" if wide else "<u2").astype("<u4")
                if held and held + len(ids) > max_ids:
                    yield flush()
                    keys, arrays, held, seq = [], [], 0, seq + 1
                keys.append(d)
                arrays.append(ids)
                held += len(ids)
        if keys:
            yield flush()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written first: the ranges are found from a look at all rows, which would
    # encode every text once more.
    encoded = cut_lineage(_encoded(docs, tokenizer, end_id, keeps_space), "ids")
    ordered = (
        encoded.repartitionByRange(parts, "doc_id", "h")
        .sortWithinPartitions("doc_id", "h", "ids")
    )
    (
        ordered.select("doc_id", "wide", "ids").mapInArrow(run, schema)
        .select(F.spark_partition_id().alias("part"), "*")
        .write.parquet(path)
    )


def segment_starts(files: DataFrame) -> DataFrame:
    """(part, seq, first): ids of all segments before each. The first window
    runs over one row per range, the second inside a range."""
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = (
        Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        files.select("part", "seq", "n_ids")
        .withColumn("_at", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(bases, "part")
        .select("part", "seq", (F.col("_base") + F.col("_at")).alias("first"))
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.parquet(path)
    schema = "part int, seq long, doc_id long, at long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        for batch in batches:
            for part, seq, raw in zip(
                *(batch.column(i).to_pylist() for i in range(3)), strict=True
            ):
                seg = Segment(raw)
                n = len(seg)
                ends = np.array([seg.ends[i] for i in range(n)], np.int64)  # by select
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                ids = seg.ids.astype("<u4")
                sums = [crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seq, np.int64)),
                        pa.array(seg.doc_ids, pa.int64()), pa.array(starts), pa.array(ends - starts),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    rows = files.select("part", "seq", "payload").mapInArrow(run, schema)
    return rows.join(segment_starts(files), ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32",
    )


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/panelops-{name}-{uuid.uuid4().hex}"

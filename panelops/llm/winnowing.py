"""Document fingerprints by winnowing.

Every word is hashed, k consecutive word hashes are combined into a rolling
(cyclic polynomial) k-gram hash, and of every window of w consecutive k-grams
the smallest hash is kept, the rightmost of ties, with its position. A run of
words that two texts share is found by a common fingerprint whenever it has at
least ``k + w - 1`` words (11 here), and no match shorter than k words is ever
reported.

A k-gram is carried as one long: the high 40 bits of its hash, then the
complement of its position in 24 bits, so the smallest long is the smallest
hash and, among ties, the rightmost. The k-gram hash and the window minimum
are built by doubling (1, 2, 4, ... elements), a few array passes in all.

Native: DataFrame functions only.

Defined cases: a text with fewer than k words but at least one has the hash
of its whole word sequence at position 0; null, empty and blank texts have an
empty fingerprint; the likeness of two empty fingerprints is 1, of an empty
and another 0. Positions are kept modulo 2^24 (16.7 million words).
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.llm.common import let, words

K_DOUBLINGS = 2  # k = 4 words
W_DOUBLINGS = 3  # w = 8 k-grams
POSITION_MASK = (1 << 24) - 1

DOCS_PER_BUCKET = 1000
MAX_BUCKETS = 10_000
NULL_ID = -(1 << 62)


def _rotate(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def _kgram_hashes(x: Column, doublings: int) -> Column:
    """Rolling hashes of 2^doublings words from the word hashes ``x``; null at
    positions where no whole k-gram starts."""
    if doublings == 0:
        return x
    half = 1 << (doublings - 1)
    return let(
        _kgram_hashes(x, doublings - 1),
        lambda g: F.transform(g, lambda a, i: _rotate(a, half).bitwiseXOR(F.get(g, i + half))),
    )


def _window_minima(v: Column, doublings: int) -> Column:
    """Minimum of each element and the 2^doublings - 1 after it, as far as
    there are any."""
    if doublings == 0:
        return v
    half = 1 << (doublings - 1)
    return let(
        _window_minima(v, doublings - 1),
        lambda m: F.transform(m, lambda a, i: F.least(a, F.get(m, i + half))),
    )


def _pack(h: Column, position: Column) -> Column:
    return h.bitwiseAND(F.lit(~POSITION_MASK)).bitwiseOR(
        F.lit(POSITION_MASK) - position.cast("bigint").bitwiseAND(F.lit(POSITION_MASK))
    )


def hash_of(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 24)


def position_of(packed: Column) -> Column:
    return F.lit(POSITION_MASK) - packed.bitwiseAND(F.lit(POSITION_MASK))


def fingerprint(
    text: Column, k_doublings: int = K_DOUBLINGS, w_doublings: int = W_DOUBLINGS
) -> Column:
    """Packed fingerprint of ``text`` (array of longs, ascending positions)."""
    k, w = 1 << k_doublings, 1 << w_doublings

    def select(v: Column) -> Column:
        windows = F.greatest(F.size(v) - (w - 1), F.lit(1))
        minima = F.slice(_window_minima(v, w_doublings), F.lit(1), windows)
        return let(
            minima,
            lambda m: F.filter(m, lambda a, i: (i == 0) | (a != F.get(m, i - 1))),
        )

    def of_words(ws: Column) -> Column:
        n = F.size(ws)
        grams = F.slice(
            _kgram_hashes(F.transform(ws, lambda x: F.xxhash64(x)), k_doublings),
            F.lit(1), F.greatest(n - (k - 1), F.lit(0)),
        )
        packed = F.transform(grams, lambda h, i: _pack(h, i))
        short = F.array(_pack(F.xxhash64(F.array_join(ws, " ")), F.lit(0)))
        return (
            F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n < k, short)
            .otherwise(let(packed, select))
        )

    return let(words(text), of_words)


def to_text(packed: Column) -> Column:
    """``hash:position`` pairs, hash in hex, separated by spaces."""
    return F.array_join(
        F.transform(
            packed,
            lambda v: F.concat_ws(":", F.hex(hash_of(v)), position_of(v).cast("string")),
        ),
        " ",
    )


def hashes(packed: Column) -> Column:
    return F.transform(packed, hash_of)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two packed fingerprints, by hash."""
    ha, hb = hashes(a), hashes(b)
    union = F.size(F.array_union(ha, hb))
    return F.when(union == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(ha, hb)) / union
    )


def with_next(docs: DataFrame, docs_per_bucket: int = DOCS_PER_BUCKET) -> DataFrame:
    """Each document with the text of the next one by doc_id (the first
    follows the last): doc_id, text, next_text, ``_b``, ``_tail``, ``_key``.

    Documents are cut into id ranges of about equal counts. Each range also
    receives the first document of the range after it (``_tail``; one row per
    range), so a window per range finds every successor and each text is
    shuffled once. ``_tail`` rows are returned too and are to be dropped by
    the caller once windows are done.
    """
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(NULL_ID))
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("_key"),
        key.cast("double").alias("_d"),
    )
    ids = rows.select("_key", "_d")
    n = min(max(1, -(-docs.count() // docs_per_bucket)), MAX_BUCKETS)
    cuts = ids.approxQuantile("_d", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) > 2:
        bucketizer = Bucketizer(splits=splits, inputCol="_d", outputCol="_r")
        cut = lambda df: bucketizer.transform(df).withColumn("_b", F.col("_r").cast("int"))
    else:
        cut = lambda df: df.withColumn("_b", F.lit(0))
    # One row per range: at most MAX_BUCKETS pairs of numbers.
    firsts = sorted(cut(ids).groupBy("_b").agg(F.min("_key").alias("_key")).collect())
    follow = [
        (b, firsts[(i + 1) % len(firsts)]["_key"]) for i, (b, _) in enumerate(firsts)
    ] or [(0, 0)]
    tails = spark.createDataFrame(follow, "_b int, _key bigint")
    tail_rows = rows.join(F.broadcast(tails), "_key").select(
        "doc_id", "text", "_key", "_b", F.lit(1).alias("_tail")
    )
    every = cut(rows).select("doc_id", "text", "_key", "_b", F.lit(0).alias("_tail"))
    return every.unionByName(tail_rows).withColumn(
        "next_text", F.lead("text").over(range_window())
    )


def range_window() -> Window:
    return Window.partitionBy("_b").orderBy("_tail", "_key", "text")


def compare_with_next(docs: DataFrame, docs_per_bucket: int = DOCS_PER_BUCKET) -> DataFrame:
    """Fingerprints of every text, of its edited text (the second half
    replaced by the start of the next text) and their likeness.

    Returns doc_id, n_chars, edited, fingerprint and edited_fingerprint
    (packed), near_edited, near_next.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    return (
        with_next(docs, docs_per_bucket)
        .withColumn("_fp", fingerprint(F.col("text")))
        .withColumn("_next_fp", F.lead("_fp").over(range_window()))
        .where(F.col("_tail") == 0)
        .select(
            "doc_id", n.cast("bigint").alias("n_chars"), "_fp", "_next_fp",
            F.concat(
                F.substring("text", F.lit(1), n - half),
                F.substring("next_text", F.lit(1), half),
            ).alias("edited"),
        )
        .withColumn("_edited_fp", fingerprint(F.col("edited")))
        .select(
            "doc_id", "n_chars", "edited",
            F.col("_fp").alias("fingerprint"),
            F.col("_edited_fp").alias("edited_fingerprint"),
            likeness(F.col("_fp"), F.col("_edited_fp")).alias("near_edited"),
            likeness(F.col("_fp"), F.col("_next_fp")).alias("near_next"),
        )
    )

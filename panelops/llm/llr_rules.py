"""Quality rules with a hashed n-gram log-likelihood ratio.

Words and word pairs of every document are hashed into ``BUCKETS`` cells. Two
multinomials are counted over the cells: the raw corpus (all documents) and
the trusted target (documents marked as good). Each cell's ratio is

    llr(b) = ln( (t_b + K * r_b / R) / (T + K) ) - ln( r_b / R )

(target counts smoothed by the raw distribution with K = 4 B pseudo-counts, so
a cell without evidence has a ratio near 0), and a document's score is the
mean ratio of its n-grams. An n-gram is never its own evidence: it is taken
out of r_b, and out of t_b if its document is trusted, before the ratio is
formed; otherwise small corpora would favour the trusted documents. Every document with a score below ``MIN_SCORE`` is
rejected; the threshold is a constant, so a document's verdict depends on
nothing but its text and the two count tables.

Base rules: fewer than ten words, or more than a fifth of the words inside
repeated five-word windows, reject a document before the ratio is looked at.

Windows are compared by 64-bit hashes inside one document; a document of
20,000 words has a false repeat with a chance of about 1e-11.

Native: DataFrame functions only. The counts are pre-aggregated per task over
a fixed number of cells, so frequent words never meet in one task; the ratio
table has at most BUCKETS rows (about 1 MB), which bounds its broadcast.

Defined cases: a null, empty or blank text has no words, fails the base rules
and has a null score; without trusted documents all ratios are 0 (T = 0 leaves the
smoothing alone) and the base rules alone decide; repeated rows are judged each by itself; extra columns
are ignored; a document may have several trusted rows, it counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import SPACES, let, words
from panelops.session import cut_lineage

BUCKETS = 65536
MIN_SCORE = -0.1
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
PSEUDO = 4  # pseudo-counts per cell
# Fixed value of the query contract.
SYMBOL_CLASS = "#*$%&|<>"


def repeated_window_words(w: Column, size: int = WINDOW) -> Column:
    """Words inside ``size``-word windows that occur twice or more in ``w``."""

    def covered(pos: Column) -> Column:
        """``pos``: ascending starts of repeated windows."""
        steps = F.transform(
            pos, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(pos, k + 1) - p, F.lit(size)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def repeated_starts(s: Column) -> Column:
        """``s``: (hash, start) sorted."""
        hit = F.filter(
            s,
            lambda e, k: F.coalesce(e["h"] == F.get(s, k - 1)["h"], F.lit(False))
            | F.coalesce(e["h"] == F.get(s, k + 1)["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(hit, lambda e: e["i"]))

    def from_hashes(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        slow = let(F.sort_array(pairs), lambda s: let(repeated_starts(s), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(slow)

    def from_words(ws: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(ws) - size),
            lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(size)]),
        )
        return F.when(F.size(ws) <= size, F.lit(0)).otherwise(let(hashes, from_hashes))

    return let(w, from_words).cast("bigint")


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the word array and the base statistics."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    return (
        docs.select("doc_id", text.alias("text"), words(text).alias("w"))
        .select(
            "doc_id", "w",
            F.size("w").cast("bigint").alias("n_words"),
            F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
            F.length(F.regexp_replace("text", f"[^{SYMBOL_CLASS}]+", "")).cast("bigint").alias(
                "n_symbols"
            ),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias(
                "n_dup_lines"
            ),
            repeated_window_words(F.col("w")).alias("n_repeat_words"),
        )
    )


def with_cells(rows: DataFrame, keep: list[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per n-gram cell of ``w``: the word, and the word with its
    successor. Rows without words stay, with a null cell."""
    ngrams = rows.select(*keep, "w", F.posexplode_outer("w").alias("_i", "_x"))
    nxt = F.get(F.col("w"), F.col("_i") + 1)
    one = F.pmod(F.xxhash64("_x"), F.lit(buckets))
    two = F.when(nxt.isNotNull(), F.pmod(F.xxhash64("_x", nxt), F.lit(buckets)))
    return ngrams.select(
        *keep,
        F.explode(F.array(one.cast("int"), two.cast("int"))).alias("cell"),
        F.col("_x").isNull().alias("_empty"),
    ).where(F.col("cell").isNotNull() | F.col("_empty")).select(
        *keep, F.when(~F.col("_empty"), F.col("cell")).alias("cell")
    )


def cell_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(cell, llr) of every cell that occurs; ``trusted``: doc_id."""
    marks = trusted.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # Hash join: the marks are the build side, texts stream past unsorted.
    flagged = (
        docs.select("doc_id", "text")
        .join(marks.withColumn("_t", F.lit(1)).hint("shuffle_hash"), "doc_id", "left")
        .select(F.coalesce("_t", F.lit(0)).alias("t"), words(F.col("text")).alias("w"))
    )
    counts = (
        with_cells(flagged.where(F.size("w") > 0), ["t"], buckets)
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("r"), F.sum("t").alias("t"))
    )
    # At most ``buckets`` rows from here on; written once, as they are read for
    # the totals and for the ratios.
    counts = cut_lineage(counts, "cells")
    raw_total, target_total = counts.agg(F.sum("r"), F.sum("t")).first()
    pseudo = float(PSEUDO * buckets)

    def ratio(t: Column) -> Column:
        share = (F.col("r") - 1) / F.lit(float(raw_total or 1))
        target = (t + F.lit(pseudo) * share) / F.lit((target_total or 0) + pseudo)
        return F.when(F.col("r") > 1, F.log(target / share)).otherwise(F.lit(0.0))

    return counts.select(
        "cell", ratio(F.col("t")).alias("llr"),
        ratio(F.greatest(F.col("t") - 1, F.lit(0))).alias("llr_trusted"),
    )


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    min_score: float = MIN_SCORE,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Base statistics, ratio score and verdict of every document.

    ``docs`` needs doc_id and text, ``trusted`` doc_id.
    """
    ratios = cut_lineage(cell_ratios(docs, trusted, buckets).coalesce(1), "llr")
    stats = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = text_statistics(docs).withColumn("_row", F.monotonically_increasing_id())
    scored = (
        with_cells(rows, ["_row", *stats], buckets)
        .join(F.broadcast(ratios), "cell", "left")  # at most ``buckets`` rows
        .groupBy("_row")
        .agg(*[F.first(c).alias(c) for c in stats], F.avg("llr").alias("_out"),
             F.avg("llr_trusted").alias("_in"))
    )
    marks = trusted.select("doc_id", F.lit(True).alias("_t")).distinct()
    score = F.when(F.coalesce("_t", F.lit(False)), F.col("_in")).otherwise(F.col("_out"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        scored.join(marks, "doc_id", "left")
        .withColumn("score", F.round(score, 6))
        .select(
            *stats,
            failed.alias("base_failed"),
            (~failed & (F.coalesce("score", F.lit(0.0)) >= F.lit(min_score))).alias("kept"),
            "score",
        )
    )

"""Quality classifier: a factorisation machine over text features.

    score = sigmoid(w0 + <w, x> + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ])

The bracket is the sum-of-squares identity: all pairwise interactions
``<v_i, v_j> x_i x_j`` cost one pass over the non-zero features per factor.

Features x of a text: hashed words (log counts, scaled to unit length),
structure statistics (shares of character classes, repeated words and lines,
word lengths) and metadata (the size class of ``n_chars``). Labels, language,
source and ids are never features, so equal texts of equal ``n_chars`` get
equal scores.

Training: a bounded sample of the labelled rows (``max_train`` rows, those
with the smallest hash of doc_id) is turned into features by Spark tasks, and
only those bounded features reach the driver, where mini-batch Adam on the
logistic loss fits the model. Scoring covers every whole text, in Arrow
batches; the model is a few hundred kB and travels with the function.

Defined cases: a null text is scored like an empty one; a null ``n_chars``
counts as the text's length; a document with several labels has the lowest;
without any usable label every score is 1.0 (nothing speaks against a text).
Repeated rows of a document are one training row (the one with the smallest
text) and a scored row each; texts of any length are read whole; ties of the
sample's hash go to the smaller id; an empty table gives no rows. Extra columns
stay as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.llm.caches import claim, register

BUCKETS = 4096
FACTORS = 8
MAX_TRAIN = 12_000
EPOCHS = 12
BATCH = 256
MAX_CACHED_WORDS = 500_000

STATS = ["words", "mean_length", "upper", "digits", "marks", "symbols", "bars", "bangs", "blank",
         "distinct", "top_word", "repeated_lines", "line_words", "marked_words", "other"]
SIZES = 20  # size classes of n_chars
WIDTH = BUCKETS + len(STATS) + SIZES

# Character classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 blank,
# 5 marks, 6 symbols, 7 bar, 8 bang.
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _s = chr(_c)
    if _c >= 128 or "a" <= _s <= "z":
        _CLASS[_c] = 1
    elif "A" <= _s <= "Z":
        _CLASS[_c] = 2
    elif "0" <= _s <= "9":
        _CLASS[_c] = 3
    elif _s in " \t\n\x0b\x0c\r":
        _CLASS[_c] = 4
    elif _s in ".,;:?'\"()-":
        _CLASS[_c] = 5
    elif _s in "#*$%&<>@~^_=+/\\{}[]`":
        _CLASS[_c] = 6
    elif _s == "|":
        _CLASS[_c] = 7
    elif _s == "!":
        _CLASS[_c] = 8

_MARKED = re.compile(r"[^\s.,;:?!'\"()\w]{2,}(?=\s|\Z)")


class _Buckets(dict):
    """word -> bucket, filled on first use; one per Python worker."""

    def __missing__(self, word: str) -> int:
        b = zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS
        self[word] = b
        return b


_WORD_BUCKETS = register("quality words", _Buckets())


def features(text: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values) of the non-zero features of one text."""
    text = text or ""
    if len(_WORD_BUCKETS) > MAX_CACHED_WORDS:
        _WORD_BUCKETS.clear()
    words = text.split()
    n = len(words)
    stats = np.zeros(len(STATS), np.float32)
    index = np.empty(0, np.int64)
    values = np.empty(0, np.float32)
    if n:
        hashed = np.fromiter(map(_WORD_BUCKETS.__getitem__, words), np.int64, n)
        counts = np.bincount(hashed, minlength=BUCKETS)
        index = np.flatnonzero(counts)
        values = np.log1p(counts[index]).astype(np.float32)
        values /= np.sqrt((values * values).sum())
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        by_class = np.bincount(_CLASS[raw], minlength=9) / len(raw)
        lines = text.split("\n")
        stats[:] = [
            np.log1p(n) / 10, min(len(text) / n / 20, 2), by_class[2], by_class[3] * 5,
            by_class[5] * 3, by_class[6] * 3, by_class[7] * 3, by_class[8] * 3, by_class[4],
            len(set(words)) / n, counts.max() / n, 1 - len(set(lines)) / len(lines),
            min(n / len(lines) / 100, 1), len(_MARKED.findall(text)) / n, by_class[0] * 10,
        ]
    size = len(text) if n_chars is None or n_chars != n_chars else int(n_chars)
    at = np.flatnonzero(stats)
    klass = min(max(size, 0).bit_length(), SIZES - 1)
    return (
        np.concatenate([index, BUCKETS + at, [BUCKETS + len(STATS) + klass]]).astype(np.int32),
        np.concatenate([values, stats[at], [0.5]]).astype(np.float32),
    )


@dataclass
class Model:
    w0: float
    w: np.ndarray  # WIDTH
    v: np.ndarray  # WIDTH x FACTORS

    def margins(self, index: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Linear-time margins of rows laid end to end (``starts`` per row)."""
        vx = self.v[index] * values[:, None]
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat((vx * vx).sum(axis=1), starts)
        linear = np.add.reduceat(self.w[index] * values, starts)
        return self.w0 + linear + 0.5 * ((sums * sums).sum(axis=1) - squares)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """Mini-batch Adam on the logistic loss with a little weight decay."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    model = Model(
        float(np.log(share / (1 - share))),
        np.zeros(WIDTH, np.float32),
        rng.normal(0, 0.05, (WIDTH, FACTORS)).astype(np.float32),
    )
    params = [np.zeros(1, np.float32), model.w, model.v]
    params[0][0] = model.w0
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    lr, decay, step = 0.02, 1e-4, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            index = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            sizes = np.array([len(rows[i][0]) for i in chosen])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            model.w0 = float(params[0][0])
            err = _sigmoid(model.margins(index, values, starts)) - labels[chosen]
            err = (err / len(chosen)).astype(np.float32)
            per = np.repeat(err, sizes)
            vx = model.v[index] * values[:, None]
            sums = np.repeat(np.add.reduceat(vx, starts, axis=0), sizes, axis=0)
            gw = np.bincount(index, per * values, minlength=WIDTH)
            gv = np.empty_like(model.v)
            inner = (per * values)[:, None] * (sums - vx)
            for f in range(FACTORS):
                gv[:, f] = np.bincount(index, inner[:, f], minlength=WIDTH)
            grads = [np.array([err.sum()]), gw + decay * model.w, gv + decay * model.v]
            step += 1
            for p, g, m, s in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                hat = (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
                p -= (lr * hat).astype(np.float32)
    model.w0 = float(params[0][0])
    return model


def _feature_rows(labelled: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        claim("quality words")
        for pdf in batches:
            found = [
                features(t, n) for t, n in zip(pdf["text"], pdf["n_chars"], strict=True)
            ]
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"], "label": pdf["label"],
                    "idx": [i.tobytes() for i, _ in found],
                    "val": [v.tobytes() for _, v in found],
                }
            )

    return labelled.mapInPandas(run, "doc_id long, label int, idx binary, val binary")


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model | None:
    """Fit on at most ``max_train`` labelled rows; None without a usable label.

    ``docs``: doc_id, text, n_chars. ``labels``: doc_id, label (0/1). The
    sample is fixed by the hash of doc_id, so reruns agree.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    sample = (
        known.groupBy("doc_id").agg(F.min(F.col("label").cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train)
    )
    # At most max_train pairs of numbers, so the join is a broadcast.
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(sample), "doc_id")
    # One row per id, reduced by the tasks that read them.
    rows = rows.groupBy("doc_id", "label").agg(F.min(F.struct("text", "n_chars")).alias("_t"))
    rows = rows.select("doc_id", "label", "_t.text", "_t.n_chars")
    got = sorted(_feature_rows(rows).collect(), key=lambda r: r["doc_id"])
    if not got:
        return None
    data = [(np.frombuffer(r["idx"], np.int32), np.frombuffer(r["val"], np.float32)) for r in got]
    return train(data, np.array([r["label"] for r in got], np.float64))


def score(text: Column, n_chars: Column, model: Model | None) -> Column:
    """Probability of label 1 for every row."""
    if model is None:
        return F.lit(1.0)

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        claim("quality words")
        for texts, sizes in batches:
            out = np.empty(len(texts))
            for at in range(0, len(texts), 256):
                rows = [
                    features(t, n)
                    for t, n in zip(texts[at : at + 256], sizes[at : at + 256], strict=True)
                ]
                lengths = np.array([len(i) for i, _ in rows])
                starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                margins = model.margins(
                    np.concatenate([i for i, _ in rows]),
                    np.concatenate([v for _, v in rows]), starts,
                )
                out[at : at + len(rows)] = _sigmoid(margins.astype(np.float64))
            yield pd.Series(out)

    return run(text, n_chars.cast("double"))


def score_documents(docs: DataFrame, model: Model | None, out: str = "score") -> DataFrame:
    return docs.withColumn(out, score(F.col("text"), F.col("n_chars"), model))

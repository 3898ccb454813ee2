"""Gradient-boosted regression trees for squared loss, fitted on Spark.

The model starts from the mean label; every tree is fitted to what is left
and added with the learning rate, the first one too.

1. *Edges.* Each feature gets at most ``bins - 1`` split points: the values
   at ranks ``floor(j n / bins)`` (:func:`panelops.functions.quantiles.
   ranked_values`), each value once. A feature with few values has them all.
2. *Blocks.* Rows become bin numbers (one byte each) and an integer label, in
   blocks of ``BLOCK_ROWS`` rows, written once to the shared checkpoint
   folder.
3. *Levels.* A tree level is one pass: every task adds up count and residual
   per (node, feature, bin) over its blocks; a shuffle by feature adds up the
   tasks' sums and chooses each feature's best split of each node. The driver
   gets those splits alone, a few numbers per (node, feature) whatever the
   number of tasks, and takes each node's, largest gain first, ties to the
   lowest feature and bin. Up to ``DIRECT_TASKS`` tasks send their sums to the
   driver, which does the same with them: a shuffle of so little costs more
   than the pass. Leaf values follow from the last level's sums, so a tree of
   depth 3 takes three passes.
4. *Refresh.* Every ``REFRESH`` trees the blocks in memory are formed again
   from the written ones with what the trees so far leave of the label, so a
   pass applies at most that many trees. Blocks are kept in memory or on disk;
   what an executor takes with it is formed again from the written blocks.

The passes run over the blocks as an RDD of byte strings: a fit is hundreds of
passes of array arithmetic over the same few columns, and planning each as a
query would cost more than the pass.

Labels, residuals and leaf values are integers in units of ``2 ** -shift``
(``shift`` follows from the number and size of the labels, so that no sum can
overflow). Integer sums do not depend on their order: the same rows give the
same trees to the bit under any partitioning, executor loss included.

Defined cases: rows with a null or NaN feature or label are left out of the
fit; no rows at all is an error. Constant features are never split. Infinite
features order as such. A prediction needs every feature, else it is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.functions.quantiles import ranked_values
from panelops.session import cut_lineage

BINS = 128  # at most 256: a bin number is one byte
BLOCK_ROWS = 16_384
TASK_ROWS = 16 * BLOCK_ROWS  # of a pass with more tasks than cores
DIRECT_TASKS = 8  # the driver adds up the sums of so many tasks, a shuffle those of more
ADDING_TASKS = 4  # tasks that add up the sums of a level
REFRESH = 25
BLOCK_SCHEMA = "n long, bins binary, left binary"


@dataclass
class Tree:
    """Nodes in breadth-first order; node ``k`` has the children at
    ``left[k]`` and ``left[k] + 1``, or is a leaf (``left[k] == -1``).
    Rows with ``bin <= cut`` (``x <= threshold``) go left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[int] = field(default_factory=list)  # integer units
    cover: list[int] = field(default_factory=list)

    def add(self, n: int) -> int:
        for column, v in ((self.feature, -1), (self.cut, -1), (self.left, -1), (self.value, 0)):
            column.append(v)
        self.cover.append(n)
        return len(self.left) - 1

    def leaf_of(self, goes_left, node: int = 0):
        """Number of the leaf of every row (a single number if the node is a
        leaf); ``goes_left(k)`` tells it of node k for all rows.

        By bit masks: ``np.where`` of two numbers takes ten times as long.
        """
        kind = np.uint8 if len(self.left) <= 256 else np.uint32
        child = self.left[node]
        if child < 0:
            return kind(node)
        left = self.leaf_of(goes_left, child)
        right = self.leaf_of(goes_left, child + 1)
        mask = np.negative(np.asarray(goes_left(node)).astype(kind))  # all bits or none
        return right ^ ((left ^ right) & mask)

    def per_row(self, goes_left, of_node: np.ndarray):
        """``of_node[k]`` of the leaf k of every row."""
        return of_node.take(self.leaf_of(goes_left))


@dataclass
class Boosted:
    edges: list[list[float]]
    trees: list[Tree]
    base: int  # integer units
    shift: int
    n: int

    @property
    def unit(self) -> float:
        return 2.0**-self.shift

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base, np.int64)
        columns = np.ascontiguousarray(x.T)
        for t in self.trees:
            total += t.per_row(
                lambda k, t=t: columns[t.feature[k]] <= self.edges[t.feature[k]][t.cut[k]],
                np.array(t.value, np.int64),
            )
        return total * self.unit

    def nodes(self) -> pd.DataFrame:
        """Node table: tree_id, node_id, value, cover, left, right, feature,
        threshold, weight; ``base * unit`` is the prediction without trees."""
        rows = [
            (
                i, k, t.value[k] * self.unit, float(t.cover[k]), t.left[k],
                t.left[k] + 1 if t.left[k] >= 0 else -1, t.feature[k],
                self.edges[t.feature[k]][t.cut[k]] if t.left[k] >= 0 else None, 1.0,
            )
            for i, t in enumerate(self.trees)
            for k in range(len(t.left))
        ]
        names = ["tree_id", "node_id", "value", "cover", "left", "right", "feature", "threshold",
                 "weight"]
        return pd.DataFrame(rows, columns=names)


def _rounded(total: Fraction) -> int:
    """Nearest integer, halves up."""
    return (2 * total.numerator + total.denominator) // (2 * total.denominator)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    columns = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]
    return np.column_stack(columns)


def _blocks(rows: DataFrame, edges: list[list[float]], base: int, shift: int) -> DataFrame:
    """``rows``: the features, then the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def block() -> pa.RecordBatch:
            x = np.concatenate(held)
            bins = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]
            label = np.rint(x[:, -1] * 2.0**shift).astype(np.int64) - base
            raw = np.array(bins, np.uint8).tobytes()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([len(x)], pa.int64()), pa.array([raw], pa.binary()),
                    pa.array([label.tobytes()], pa.binary()),
                ],
                names=["n", "bins", "left"],
            )

        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                held.append(_matrix(batch.slice(at, BLOCK_ROWS)))
                size += len(held[-1])
                if size >= BLOCK_ROWS:
                    yield block()
                    held, size = [], 0
        if size:
            yield block()

    return rows.mapInArrow(run, BLOCK_SCHEMA)


Block = tuple[int, bytes, bytes]


def _opened(block: Block, features: int, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """(bins, residual) of a block, with ``trees`` taken off."""
    n, raw, left = block
    bins = np.frombuffer(raw, np.uint8).reshape(features, n)
    rest = np.frombuffer(left, np.int64).copy()
    for t in trees:
        rest -= t.per_row(
            lambda k, t=t: bins[t.feature[k]] <= t.cut[k], np.array(t.value, np.int64)
        )
    return bins, rest


def _kept(blocks: RDD, features: int, trees: list[Tree]) -> RDD:
    """Blocks with ``trees`` taken off, kept for the passes to come."""

    def form(block: Block) -> Block:
        bins, rest = _opened(block, features, trees)
        return len(rest), bins.tobytes(), rest.tobytes()

    return blocks.map(form).persist(StorageLevel.MEMORY_AND_DISK)


# Of one feature at one node: rows and residual of the node, then gain, cut, and
# rows and residual on the left of the best split; gain None where there is none.
FeatureSplit = tuple[int, int, float | None, int, int, int]


def _feature_split(count: np.ndarray, total: np.ndarray) -> FeatureSplit:
    """Best split of a node by one feature, from its sums per bin."""
    n, s = int(count.sum()), int(total.sum())
    below, sums = np.cumsum(count)[:-1], np.cumsum(total)[:-1]
    inside = (below > 0) & (below < n)
    if not inside.any():
        return n, s, None, 0, 0, 0
    nl, sl = np.where(inside, below, 1).astype(float), sums.astype(float)
    nr, sr = np.where(inside, n - below, 1).astype(float), float(s) - sl
    gain = np.where(inside, sl * sl / nl + sr * sr / nr - float(s) * s / n, -np.inf)
    b = int(np.argmax(gain))  # the first of equal gains
    return n, s, float(gain[b]), b, int(below[b]), int(sums[b])


def _level_splits(
    blocks: RDD, trees: list[Tree], tree: Tree, nodes: list[int], features: int, bins: int
) -> list[list[FeatureSplit]]:
    """Of every node of a level, the best split by each feature."""
    slots = np.full(len(tree.left), -1)
    slots[nodes] = range(len(nodes))

    def run(part: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        # Per feature: counts, then residuals, by node and bin.
        sums = np.zeros((features, 2, len(nodes), bins), np.int64)
        for block in part:
            binned, rest = _opened(block, features, trees)
            slot = tree.per_row(lambda k: binned[tree.feature[k]] <= tree.cut[k], slots)
            cell0 = np.broadcast_to(np.asarray(slot, np.int64) * bins, rest.shape)
            mine = cell0 >= 0
            if not mine.all():
                binned, rest, cell0 = binned[:, mine], rest[mine], cell0[mine]
            rest = rest.astype(np.float64)
            for f in range(features):
                cell = cell0 + binned[f]
                size = len(nodes) * bins
                sums[f, 0] += np.bincount(cell, minlength=size).reshape(-1, bins)
                # Exact: sums of a block stay below 2^53.
                residuals = np.bincount(cell, rest, minlength=size)
                sums[f, 1] += residuals.astype(np.int64).reshape(-1, bins)
        yield from enumerate(sums)

    def best(sums: np.ndarray) -> list[FeatureSplit]:
        return [_feature_split(sums[0, i], sums[1, i]) for i in range(len(nodes))]

    added = blocks.mapPartitions(run)
    if blocks.getNumPartitions() > DIRECT_TASKS:
        added = added.reduceByKey(lambda a, b: a + b, min(features, ADDING_TASKS))
        found = dict(added.mapValues(best).collect())
    else:
        sums: dict[int, np.ndarray] = {}
        for f, part in added.collect():
            sums[f] = sums[f] + part if f in sums else part
        found = {f: best(x) for f, x in sums.items()}
    return [[found[f][i] for f in range(features)] for i in range(len(nodes))]


def _split(found: list[FeatureSplit]) -> tuple[int, int, int, int] | None:
    """(feature, cut, rows left, residual left) of the best split of a node;
    None where no split lowers the squared error."""
    gains = [-np.inf if g is None else g for _, _, g, _, _, _ in found]
    f = int(np.argmax(gains))  # the first of equal gains
    if gains[f] <= 0:
        return None
    _, _, _, cut, nl, sl = found[f]
    return f, cut, nl, sl


def _grow(blocks, trees: list[Tree], rate: Fraction, depth: int, features: int, bins: int) -> Tree:
    tree, level, sums = Tree(), [0], {0: 0}
    tree.add(0)
    for d in range(depth):
        splits = _level_splits(blocks, trees, tree, level, features, bins)
        if d == 0:
            tree.cover[0], sums[0] = splits[0][0][:2]
        deeper = []
        for i, k in enumerate(level):
            found = _split(splits[i])
            if found is None:
                continue
            f, b, nl, sl = found
            left = tree.add(nl)
            right = tree.add(tree.cover[k] - nl)
            sums[left], sums[right] = sl, sums[k] - sl
            tree.feature[k], tree.cut[k], tree.left[k] = f, b, left
            deeper += [left, right]
        level = deeper
        if not level:
            break
    for k, child in enumerate(tree.left):
        if child < 0:
            tree.value[k] = _rounded(rate * sums[k] / max(tree.cover[k], 1))
    return tree


def _shift(n: int, largest: float) -> int:
    """Binary digits after the point: residuals (at most four times the
    largest label) below 2^37, and their sum over all rows below 2^62."""
    magnitude = int(np.ceil(np.log2(max(largest, 2.0**-30)))) + 2
    return max(-magnitude, min(32, 36 - magnitude, 61 - n.bit_length() - magnitude))


def fit(
    rows: DataFrame,
    features: list[str],
    label: str,
    n_trees: int,
    depth: int,
    rate: float,
    bins: int = BINS,
) -> Boosted:
    cols = list(features)
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    data = cut_lineage(
        rows.select(*[number(c).alias(f"f{i}") for i, c in enumerate(cols)], number(label).alias("y"))
        .dropna(),
        "boost-rows",
    )
    n, largest = data.agg(F.count(F.lit(1)), F.max(F.abs("y"))).first()
    if not n:
        raise ValueError("boosting needs at least one complete training row")
    names = [f"f{i}" for i in range(len(cols))]
    edges = ranked_values(data, names, [j * n // bins for j in range(1, bins)])
    shift = _shift(n, largest)
    # The sum of the rounded labels is exact, so the start value is as well.
    whole = F.sum(F.rint(F.col("y") * F.lit(2.0**shift)).cast("decimal(38,0)"))
    base = _rounded(Fraction(int(data.agg(whole).first()[0]), n))
    # No more tasks than full blocks: a pass over few rows is one task.
    packed = _blocks(data.coalesce(max(1, -(-n // BLOCK_ROWS))), edges, base, shift)
    tasks = -(-n // TASK_ROWS)
    if tasks > DIRECT_TASKS:
        tasks = max(tasks, rows.sparkSession.sparkContext.defaultParallelism)
    else:
        tasks = DIRECT_TASKS
    written = cut_lineage(packed, "boost-blocks").coalesce(tasks).rdd.map(
        lambda r: (r["n"], bytes(r["bins"]), bytes(r["left"]))
    )
    exact_rate = Fraction(str(rate))
    trees: list[Tree] = []
    blocks, fresh = _kept(written, len(cols), []), 0
    for k in range(n_trees):
        if k - fresh == REFRESH:
            blocks.unpersist()
            blocks, fresh = _kept(written, len(cols), list(trees)), k
        trees.append(_grow(blocks, trees[fresh:], exact_rate, depth, len(cols), bins))
    blocks.unpersist()
    return Boosted(edges, trees, base, shift, int(n))


def predict(df: DataFrame, model: Boosted, features: list[str], out: str) -> DataFrame:
    """``df`` with ``out``; null where a feature is missing (null or NaN)."""
    schema = T.StructType([f for f in df.schema.fields if f.name != out] + [
        T.StructField(out, T.DoubleType())
    ])
    kept = [f for f in df.columns if f != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.select([f"_x{i}" for i in range(len(features))]))
            whole = ~np.isnan(x).any(axis=1)
            y = model.predict(x)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(y, pa.float64(), mask=~whole)],
                names=[*kept, out],
            )

    nan = F.lit(float("nan"))
    inputs = [F.coalesce(F.col(c).cast("double"), nan).alias(f"_x{i}") for i, c in enumerate(features)]
    return df.select(*kept, *inputs).mapInArrow(run, schema)

"""Exact Jaccard join of documents on word shingles by T-occurrence search.

Documents are sets of five-word shingles (64-bit hashes). Two link when
``|x & y| >= 0.75 |x | y|``; the operator returns every document's component
over these links. The steps, none of which holds more than a bounded share:

1. Document frequencies of all shingles of all documents: every task sorts
   its shingles and sends them as packed arrays per hash range; a range adds
   them up. The at most MAX_HEAVY shingles of the highest frequencies (of
   MIN_HEAVY at least) go into a table of bytes by the high bits of the hash,
   which holds the level of a frequency, eight to a doubling. The table is the
   broadcast, of 2^MAX_CELL_BITS bytes at most. A rare shingle that shares a
   cell is ordered as if it were frequent, in every set alike.
2. Each set is ordered by (level, hash), the rarest first, and its first
   ``n - ceil(0.75 n) + 1`` shingles are posted: two linked sets share at
   least one posting. A shingle of many documents is posted only by sets that
   have too few rarer ones, so a corpus of any size has few long lists.
   Postings name a set by some bits of its hash, so equal sets are one member
   of a list however often they occur.
3. Inverted lists are merged per hash range. A list of at most MAX_PAIRS sets
   (or, where the table does not hold all shingles of MIN_HEAVY documents, of
   as many as its rarest one, MAX_PAIRS_FULL at most) gives its pairs, and the
   shared postings of a pair are counted: a pair whose count and remaining
   shingles cannot reach the required overlap is dropped. A longer list gives
   star edges to its smallest member instead (joined locally before the
   shuffle, so a list with a third of all documents is a few rows a task).
4. The components of this candidate graph are the clusters that a link cannot
   leave. Each cluster is searched in blocks of bounded size, every pair of
   blocks once, by DivideSkip (``link_forest``): the short lists of a query
   document are merged, candidates that can still reach the threshold are
   probed by binary search in the long ones. Documents already connected are
   not compared again, so a group of near copies costs a few queries.
5. Components of the links found, with exact copies (equal sets) attached.

Defined cases: a null, empty or blank text has an empty set, links with
nothing and is its own component; a text of fewer than five words is one
shingle of its whole word sequence; rows with the same doc_id are one node;
a null doc_id links with nothing and has a null component; extra columns are
ignored; an empty table gives no rows. Sets are compared by hashes: a false
match of two shingles of a corpus of 10^9 has a chance of a few percent, of
a false link practically none.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.llm.caches import claim, register
from panelops.llm.components import components
from panelops.session import cut_lineage

SHINGLE = 5
PERCENT = 75
MAX_HEAVY = 1 << 23
MIN_HEAVY = 32
MAX_CELL_BITS = 25
LEVELS = 8  # of frequency in a doubling
MAX_PAIRS = 32
MAX_PAIRS_FULL = 128
SPARE_BITS = 12  # a set's short id collides with another's once in 2^12 sets
BLOCK_DOCS = 2000
BLOCK_SHINGLES = 2_000_000
FLUSH = 2_000_000  # shingles a task holds before it sends them
DOCS_PER_RANGE = 5_000
MAX_CACHED_WORDS = 500_000
MU = 0.0085  # DivideSkip's cost ratio

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = register("shingle words", _WordHashes())


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes. ``bytes.lower`` and ``bytes.split``
    work on A-Z and on the six blanks alone, as the contract has it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if len(_HASHES) > MAX_CACHED_WORDS:
        _HASHES.clear()
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    size = min(n, SHINGLE)
    s = w[: n - size + 1].copy()
    for j in range(1, size):
        s ^= s >> np.uint64(29)
        s *= _M1
        s += w[j : n - size + 1 + j]
    s += np.uint64(size)
    s ^= s >> np.uint64(32)
    s *= _M2
    s ^= s >> np.uint64(29)
    return np.unique(s)


def prefix_length(n: int) -> int:
    return n - -(-n * PERCENT // 100) + 1


def _planes(a: np.ndarray) -> bytes:
    """Bytes of ``a`` grouped by significance: small numbers compress."""
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def _unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype)[:, 0]


def _sums(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values (ascending) and the sum of their weights."""
    order = np.argsort(values, kind="stable")
    v, w = values[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    return v[first], np.add.reduceat(w, first)


def _by_range(tokens: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(range, from, to) slices of ascending ``tokens`` by their high bits."""
    high = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(high[1:] != high[:-1]) + 1, [len(high)]])
    return [(int(high[a]), int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _low32(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits below the range bits."""
    return ((tokens >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def frequency_levels(docs: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """Levels of the frequent shingles by the high bits of their hashes (0:
    rare), and the length up to which an inverted list gives pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingle words")
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            held.clear()
            tokens.sort()
            first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            counts = np.diff(np.concatenate([first, [len(tokens)]])).astype(np.uint32)
            tokens = tokens[first]
            low = _low32(tokens, bits)
            rows = []
            for r, a, b in _by_range(tokens, bits):
                steps = np.diff(low[a:b], prepend=low[a : a + 1] * 0)
                rows.append((r, _planes(steps), _planes(counts[a:b])))
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(
                    zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True
                )],
                names=["range", "tokens", "counts"],
            )

        for batch in batches:
            for text in batch.column(0):
                s = shingle_set(text.as_py())
                if len(s):
                    held.append(s)
                    size += len(s)
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    def add_up(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        low = [np.cumsum(_unplanes(t, np.uint32), dtype=np.uint32) for t in pdf["tokens"]]
        counts = [_unplanes(c, np.uint32) for c in pdf["counts"]]
        tokens, df = _sums(np.concatenate(low), np.concatenate(counts).astype(np.int64))
        keep = df >= MIN_HEAVY
        ids = (np.int64(key[0]) << 32) | tokens[keep].astype(np.int64)
        levels = 1 + np.floor(LEVELS * np.log2(df[keep] / MIN_HEAVY)).astype(np.int64)
        return pd.DataFrame({"token": ids, "level": np.minimum(levels, 255)})

    packed = docs.select("text").mapInArrow(count, "range int, tokens binary, counts binary")
    counted = cut_lineage(
        packed.groupBy("range").applyInPandas(add_up, "token long, level int"), "frequent"
    )
    # At most 255 rows.
    by_level = dict(counted.groupBy("level").agg(F.count(F.lit(1))).collect())
    least, held = 256, 0
    while least > 1 and held + by_level.get(least - 1, 0) <= MAX_HEAVY:
        least -= 1
        held += by_level.get(least, 0)
    # Four cells for each shingle.
    cell_bits = max(bits, min(MAX_CELL_BITS, (4 * held).bit_length()))
    rows = counted.where(F.col("level") >= least).select(
        F.shiftrightunsigned("token", 32 + bits - cell_bits).cast("int").alias("cell"),
        F.col("level").cast("short").alias("level"),
    ).toArrow()
    table = np.zeros(1 << cell_bits, np.uint8)
    np.maximum.at(table, rows.column(0).to_numpy(), rows.column(1).to_numpy().astype(np.uint8))
    full = math.ceil(MIN_HEAVY * 2 ** ((least - 1) / LEVELS)) if least > 1 else 0
    return table, max(MAX_PAIRS, min(full, MAX_PAIRS_FULL))


def _rarest(s: np.ndarray, levels: np.ndarray, p: int) -> np.ndarray:
    """The first ``p`` shingles of a set in the order of (level, hash)."""
    bits = len(levels).bit_length() - 1
    level = levels[(s >> np.uint64(64 - bits)).astype(np.int64)]
    rare = s[level == 0]
    return rare[:p] if len(rare) >= p else s[np.argsort(level, kind="stable")[:p]]


def _postings(docs: DataFrame, levels, bits: int, most: int, id_bits: int) -> DataFrame:
    """Two kinds of rows: one per document (doc, n, p and 128 bits of its
    set), and packed postings or star edges (range, tokens, members). Members
    are sets, named by the ``id_bits`` low bits of h1."""
    mask = (1 << id_bits) - 1
    schema = "doc long, n int, p int, h1 long, h2 long, range int, tokens binary, members binary"
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
             pa.binary()]
    names = ["doc", "n", "p", "h1", "h2", "range", "tokens", "members"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        claim("shingle words")
        table = levels.value
        tokens: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        seen: set[bytes] = set()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            t, d = np.concatenate(tokens), np.concatenate(owners)
            tokens.clear()
            owners.clear()
            seen.clear()
            order = np.lexsort((d, t))
            t, d = t[order], d[order]
            new = np.concatenate([[True], (t[1:] != t[:-1]) | (d[1:] != d[:-1])])
            t, d = t[new], d[new]
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            length = np.diff(np.concatenate([first, [len(t)]]))
            # Long local lists: star edges here, and only the first member goes
            # on, in a row of its own kind (n = 1).
            within = np.repeat(length > most, length)
            if within.any():
                start = np.repeat(d[first], length)
                edges = np.unique(np.stack([start[within], d[within]], axis=1), axis=0)
                edges = np.ascontiguousarray(edges[edges[:, 0] != edges[:, 1]])
                if len(edges):
                    yield batch_of([(None, 0, None, None, None, -1, None, edges.tobytes())])
            heads = first[length > most]
            rows = []
            for mark, tt, dd in ((0, t[~within], d[~within]), (1, t[heads], d[heads])):
                low = _low32(tt, bits)
                for r, a, b in _by_range(tt, bits) if len(tt) else []:
                    steps = np.diff(low[a:b], prepend=low[a : a + 1] * 0)
                    rows.append((None, mark, None, None, None, r, _planes(steps), _planes(dd[a:b])))
            yield batch_of(rows)

        for batch in batches:
            docs_out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(text.as_py())
                n = len(s)
                p = prefix_length(n) if n else 0
                h = xxhash.xxh128_digest(s.tobytes())
                docs_out.append(
                    (doc, n, p, int.from_bytes(h[:8], "little", signed=True),
                     int.from_bytes(h[8:], "little", signed=True), None, None, None)
                )
                if not n or doc is None or h in seen:
                    continue
                seen.add(h)
                tokens.append(_rarest(s, table, p))
                owners.append(np.full(p, docs_out[-1][3] & mask, np.int64))
                size += p
            if docs_out:
                yield batch_of(docs_out)
            if size >= FLUSH:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _list_edges(pdf: pd.DataFrame, most: int) -> pd.DataFrame:
    """Pairs of the lists of at most ``most`` sets (with the number of lists a
    pair shares within this range) and star edges (count 0) of the longer ones
    of one range."""
    tokens = np.concatenate([np.cumsum(_unplanes(t, np.uint32), dtype=np.uint32) for t in pdf["tokens"]])
    members = [_unplanes(m, np.int64) for m in pdf["members"]]
    marks = np.repeat(pdf["n"].to_numpy() == 1, [len(m) for m in members])
    d = np.concatenate(members)
    order = np.lexsort((~marks, d, tokens))  # of equal postings a marked one is first
    t, d, marked = tokens[order], d[order], marks[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (d[1:] != d[:-1])])
    t, d, marked = t[new], d[new], marked[new]
    first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    length = np.diff(np.concatenate([first, [len(t)]]))
    long = (length > most) | (np.logical_or.reduceat(marked, first))
    a_out, b_out, c_out = [], [], []
    stars = np.repeat(long & (length > 1), length)
    if stars.any():
        low = np.repeat(np.minimum.reduceat(d, first), length)
        e = np.unique(np.stack([low[stars], d[stars]], axis=1), axis=0)
        e = e[e[:, 0] != e[:, 1]]
        a_out.append(e[:, 0])
        b_out.append(e[:, 1])
        c_out.append(np.zeros(len(e), np.int64))
    pairs = []
    for size in np.unique(length[~long & (length > 1)]):
        rows = d[first[(length == size) & ~long][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        pairs.append(np.stack([rows[:, i].ravel(), rows[:, j].ravel()], axis=1))
    if pairs:
        e = np.sort(np.concatenate(pairs), axis=1)
        e = e[e[:, 0] != e[:, 1]]
        if len(e):
            order = np.lexsort((e[:, 1], e[:, 0]))
            e = e[order]
            new = np.flatnonzero(np.concatenate([[True], (e[1:] != e[:-1]).any(axis=1)]))
            a_out.append(e[new, 0])
            b_out.append(e[new, 1])
            c_out.append(np.diff(np.concatenate([new, [len(e)]])))
    if not a_out:
        return pd.DataFrame({"a": [], "b": [], "c": []}, dtype=np.int64)
    return pd.DataFrame(
        {"a": np.concatenate(a_out), "b": np.concatenate(b_out), "c": np.concatenate(c_out)}
    )


def _enough(overlap: np.ndarray | int, nx: int, ny: np.ndarray | int):
    return 100 * overlap >= PERCENT * (nx + ny - overlap)


def _merge_short(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Members of ascending lists and how often each occurs."""
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if sum(map(len, lists)) <= 256:
        merged = np.fromiter(heapq.merge(*[x.tolist() for x in lists]), np.int64)
    else:
        merged = np.sort(np.concatenate(lists), kind="stable")
    first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
    return merged[first], np.diff(np.concatenate([first, [len(merged)]]))


def link_forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (i, j) that join the linked sets into their components: a
    spanning forest of the link graph, found by DivideSkip queries.

    Every pair of sets of different components has been ruled out: all
    documents but those of one component (the pivot's) query all others, and
    two documents of that component are connected anyway.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(m), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    length = np.diff(np.concatenate([first, [len(tokens)]]))
    list_of = np.empty(len(tokens), np.int64)
    list_of[order] = np.repeat(np.arange(len(first)), length)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    keys = np.repeat(np.arange(len(first)), length) * m + owner  # ascending

    comp = np.arange(m)
    links: list[tuple[int, int]] = []

    def query(x: int) -> None:
        own = list_of[starts[x] : starts[x + 1]]
        own = own[length[own] > 1]
        need = -(-sizes[x] * PERCENT // 100)  # of every partner
        if len(own) < need:
            return
        by_length = own[np.argsort(-length[own], kind="stable")]
        longest = int(length[by_length[0]])
        n_long = min(int(need / (MU * math.log2(longest + 1) + 1)), need - 1)
        long, short = by_length[:n_long], by_length[n_long:]
        found, times = _merge_short([owner[first[k] : first[k] + length[k]] for k in short])
        near = (times >= need - n_long) & (comp[found] != comp[x])
        found, times = found[near], times[near]
        for at in range(0, len(found), 512):
            cand = found[at : at + 512]
            probe = (long[:, None] * m + cand[None, :]).ravel()
            hit = np.searchsorted(keys, probe)
            hit = keys[np.minimum(hit, len(keys) - 1)] == probe
            overlap = times[at : at + 512] + hit.reshape(len(long), len(cand)).sum(axis=0)
            for y in cand[_enough(overlap, int(sizes[x]), sizes[cand])].tolist():
                if comp[y] != comp[x]:
                    links.append((x, y))
                    comp[comp == comp[y]] = comp[x]

    ahead = min(m, 16)
    for x in range(ahead):
        query(x)
    labels, members = np.unique(comp, return_counts=True)
    pivot = int(np.flatnonzero(comp == labels[members.argmax()])[0])
    for x in range(ahead, m):
        if comp[x] != comp[pivot]:
            query(x)
    return links


def _search_blocks(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Links inside each cluster of one block (or pair of blocks)."""
    pdf = pdf.sort_values(["cluster", "doc"])
    docs = pdf["doc"].to_numpy()
    clusters = pdf["cluster"].to_numpy()
    sets = [np.frombuffer(b, np.uint64) for b in pdf["tokens"]]
    cuts = np.concatenate(
        [[0], np.flatnonzero(clusters[1:] != clusters[:-1]) + 1, [len(clusters)]]
    )
    out: list[tuple[int, int]] = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a > 1:
            out += [(docs[a + i], docs[a + j]) for i, j in link_forest(sets[a:b])]
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _sets(rows: DataFrame) -> DataFrame:
    """Replace ``text`` by the shingle set of each row, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingle words")
        for batch in batches:
            at = batch.schema.names.index("text")
            tokens = pa.array([shingle_set(t.as_py()).tobytes() for t in batch.column(at)],
                              pa.binary())
            yield pa.RecordBatch.from_arrays(
                [c for i, c in enumerate(batch.columns) if i != at] + [tokens],
                names=[n for n in batch.schema.names if n != "text"] + ["tokens"],
            )

    plain = rows.drop("text")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain_order(rows).mapInArrow(run, f"{fields}, tokens binary")


def plain_order(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c != "text"], "text")


def link_documents(docs: DataFrame) -> DataFrame:
    """Component of every document: doc_id, n_shingles, component_id, one row
    per input row. ``docs`` needs doc_id and text."""
    spark = docs.sparkSession
    n_docs = docs.count()
    bits = min(max(8, math.ceil(math.log2(max(n_docs, 1) / DOCS_PER_RANGE + 1))), 20)
    levels, most = frequency_levels(docs, bits)
    id_bits = min(63, n_docs.bit_length() + SPARE_BITS)
    posted = cut_lineage(
        _postings(docs, spark.sparkContext.broadcast(levels), bits, most, id_bits), "postings"
    )

    # Documents and their classes of equal sets.
    metas = posted.where(F.col("range").isNull()).select("doc", "n", "p", "h1", "h2")
    same = ["h1", "h2", "n"]
    classes = metas.where((F.col("n") > 0) & F.col("doc").isNotNull()).groupBy(*same).agg(
        F.min("doc").alias("rep"), F.first("p").alias("p")
    )
    classes = cut_lineage(classes, "classes")
    members = metas.join(classes.select(*same, "rep"), same).where(F.col("doc").isNotNull())
    pairs = cut_lineage(members.select("doc", "rep").distinct(), "reps")
    # Rows of one id with different texts are one node: their classes are
    # joined, and from here on a group of joined classes has one name.
    least = pairs.groupBy("doc").agg(F.min("rep").alias("least"))
    joined = cut_lineage(
        pairs.join(least, "doc").where(F.col("rep") != F.col("least")).select(
            F.col("least").alias("a"), F.col("rep").alias("b")
        ).distinct(),
        "joined",
    )
    names = components(joined).select(F.col("node").alias("rep"), F.col("component").alias("name"))
    name = F.coalesce("name", "rep")
    classes = cut_lineage(classes.join(names, "rep", "left").withColumn("name", name), "named")
    rep_of = least.withColumnRenamed("least", "rep").join(names, "rep", "left")
    rep_of = cut_lineage(rep_of.select("doc", name.alias("rep")), "names")

    # Candidate edges between sets by their short ids, then between names.
    # What edges of one short id mean holds for each set that has it, and such
    # sets are candidates of each other.
    lists = posted.where(F.col("range") >= 0).select("range", "n", "tokens", "members")
    found = lists.groupBy("range").applyInPandas(
        lambda pdf: _list_edges(pdf, most), "a long, b long, c long"
    )
    local = _local_stars(posted.where(F.col("range") == -1).select("members"))
    edges = (
        found.unionByName(local.withColumn("c", F.lit(0).cast("bigint")))
        .groupBy("a", "b")
        .agg(F.sum("c").alias("c"), F.max(F.when(F.col("c") == 0, 1).otherwise(0)).alias("star"))
    )
    short = F.col("h1").bitwiseAND(F.lit((1 << id_bits) - 1))
    ids = cut_lineage(classes.select(short.alias("id"), "name").distinct(), "ids")
    a = ids.select(F.col("id").alias("a"), F.col("name").alias("ra"))
    b = ids.select(F.col("id").alias("b"), F.col("name").alias("rb"))
    first_of = ids.groupBy("id").agg(F.min("name").alias("a"), F.max("name").alias("b"))
    collided = first_of.where(F.col("a") != F.col("b")).select("id", "a").join(ids, "id").where(
        F.col("a") != F.col("name")
    ).select("a", F.col("name").alias("b"))
    sizes = classes.groupBy("name").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("p")).alias("rest")
    )
    of = lambda m: [F.col(c).alias(f"{c}_{m}") for c in ("lo", "hi", "rest")]
    sa = sizes.select(F.col("name").alias("ra"), *of("a"))
    sb = sizes.select(F.col("name").alias("rb"), *of("b"))
    # Some set of the one and some set of the other may still link.
    reachable = (
        (100 * F.col("hi_a") >= PERCENT * F.col("lo_b"))
        & (100 * F.col("hi_b") >= PERCENT * F.col("lo_a"))
        & (
            (100 + PERCENT) * (F.col("c") + F.greatest("rest_a", "rest_b"))
            >= PERCENT * (F.col("lo_a") + F.col("lo_b"))
        )
    )
    candidates = (
        edges.join(a, "a").join(b, "b").where(F.col("ra") != F.col("rb"))
        .groupBy("ra", "rb").agg(F.max("c").alias("c"), F.max("star").alias("star"))
        .join(sa, "ra").join(sb, "rb")
        .where((F.col("star") == 1) | reachable)
        .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        .unionByName(collided)
    )
    clusters = components(candidates)
    named = classes.groupBy("name", "rep").agg(F.sum("n").alias("n"))
    links = _links(docs, clusters, named)
    linked = components(links.unionByName(joined))

    comp = rep_of.join(linked.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc", F.coalesce("component", "rep").alias("component")
    )
    return metas.join(comp, "doc", "left").select(
        F.col("doc").alias("doc_id"), F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )


def _local_stars(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                e = np.frombuffer(raw, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(e[:, 0])),
                     pa.array(np.ascontiguousarray(e[:, 1]))], names=["a", "b"],
                )

    return rows.mapInArrow(run, "a long, b long")


def _links(docs: DataFrame, clusters: DataFrame, named: DataFrame) -> DataFrame:
    """Links (a, b) inside the clusters, searched block by block. ``named``:
    name, rep (the document whose text stands for a class), n."""
    placed = cut_lineage(
        clusters.select(F.col("node").alias("name"), F.col("component").alias("cluster"))
        .join(named, "name").select(F.col("rep").alias("doc"), "cluster", "n"),
        "clusters",
    )
    blocks = placed.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_DOCS)),
            F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)),
        ).cast("int").alias("nb")
    )
    # Small clusters share a task: as many bins as blocks are needed in all.
    total = placed.agg(F.count(F.lit(1)), F.sum("n")).first()
    bins = max(1, -(-total[0] // BLOCK_DOCS), -(-(total[1] or 0) // BLOCK_SHINGLES))
    own = F.pmod(F.xxhash64("doc"), F.col("nb")).cast("int")
    alone = F.array(F.struct(
        F.pmod(F.xxhash64("cluster"), F.lit(bins)).alias("k"), F.lit(-1).alias("i"),
        F.lit(-1).alias("j"),
    ))
    others = F.filter(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: o != F.col("own"))
    pairs = F.transform(
        others,
        lambda o: F.struct(
            F.col("cluster").alias("k"), F.least("own", o).alias("i"),
            F.greatest("own", o).alias("j"),
        ),
    )
    keyed = (
        placed.join(blocks, "cluster")
        .withColumn("own", own)
        .select("doc", "cluster", F.when(F.col("nb") == 1, alone).otherwise(pairs).alias("tasks"))
    )
    texts = docs.select(F.col("doc_id").alias("doc"), "text")
    rows = texts.join(keyed.hint("shuffle_hash"), "doc")
    sets = _sets(rows).select("doc", "cluster", "tokens", F.explode("tasks").alias("t"))
    found = (
        sets.select("doc", "cluster", "tokens", "t.k", "t.i", "t.j")
        .groupBy("k", "i", "j")
        .applyInPandas(_search_blocks, "a long, b long")
    )
    return cut_lineage(found, "links")

"""Repair of conversation structure as shortest paths, found by auction.

A conversation is to read ``(s?(ua)+)?``: perhaps a system turn, then user
and assistant in turns. Rows are kept, given the other role, or deleted, and
empty turns are inserted, at integer costs. Over the rows of a conversation
this is a lattice: a node is (rows done, state), a state is what the output
so far ends in (0 nothing, 1 system, 2 user, 3 assistant), an arc is an edit.

Auction (Bertsekas): every node has a price, zero at first, and a path grows
from the origin. Its last node's price is raised to the cheapest arc plus the
price behind that arc, and the node leaves the path (contraction); if its
price is that already, the path takes the arc (extension). Prices never
exceed the distances to the destination, and when the path arrives they are
distances along it. An arc is *tight* if its cost is the fall of the price
over it. All arcs of all shortest paths from the origin are tight, so the
ASCII-least list of cheapest edits is found by following tight arcs in the
order of their letters, leaving dead ends.

Whole conversations never meet in one task's memory. Rows are put in order by
a range partitioning and cut to blocks of at most ``BLOCK_ROWS`` rows:

1. per block, the costs from every state at its start to every state at its
   end (4 x 4), by auction;
2. backwards over the blocks of a conversation: the distance from every state
   at a block's end to the end of the conversation. One pass over small rows
   in order, that carries four numbers;
3. per block and state at its start: the auction against those distances, and
   the traced edits;
4. forwards over the blocks: the state each block is entered in, hence its
   edits; the turns of the block are formed from them.

So a conversation with a third of all rows is many blocks, and only the
passes 2 and 4, over one small row per block, follow it in order.

Defined cases: a null role or text is one space; a null conversation id is
one conversation; null turns come first; rows of equal turn are ordered by
(role, text); rows equal in all columns are copies, each but the first a
duplicate. A role counts by its first character; an empty role has none and
is never kept. Very long texts are carried, not looked at by the search. An
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelops.llm.common import SPACES
from panelops.session import cut_lineage

# Costs of the edits, faults in the order they are looked for,
# and the space a null stands for.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW, SOUND = 3, 2, 1, 0
INITIALS = "?sua"
NULL = " "
LEGAL_PAIRS = ("su", "ua", "au")

BLOCK_ROWS = 64
BLOCK_BYTES = 4_000_000

# State after keeping a row of each initial; None where that is not allowed.
KEPT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # after a rerole or an insertion
NAMES = {2: "user", 3: "assistant"}
# At the end of a conversation: what is still to be inserted, by state.
TAIL = ("", "II", "I", "")
FAR = 1 << 60


def end_distances() -> tuple[int, ...]:
    return tuple(INSERT * len(t) for t in TAIL)


# --- the lattice of one block -------------------------------------------------


def arcs_of(codes: bytes) -> list[list[tuple[str, int, int]]]:
    """Arcs (letter, cost, head) of every node ``4 * row + state``, in the
    order of the letters; a code is 4 * initial + fault of a row."""
    out: list[list[tuple[str, int, int]]] = []
    for i, code in enumerate(codes):
        initial, fault = INITIALS[code >> 2], code & 3
        for s in range(4):
            arcs = [("D", DELETE, 4 * i + 4 + s), ("I", INSERT, 4 * i + NEXT[s])]
            if fault < DUPLICATE_ROW:
                extra = TRUNCATED if fault == TRUNCATED_ROW else 0
                if initial in KEPT[s]:
                    arcs.append(("K", extra, 4 * i + 4 + KEPT[s][initial]))
                arcs.append(("R", REROLE + extra, 4 * i + 4 + NEXT[s]))
            out.append(arcs)
    return out


def auction(
    arcs: list[list[tuple[str, int, int]]], exits: tuple[int, ...], prices: list[int], origin: int
) -> int:
    """Distance from ``origin`` to the end of the block plus ``exits`` of the
    state there. ``prices`` (one per node) is raised in place and may come
    from an earlier origin; the destination must be reachable."""
    last = len(arcs)  # the block's end: nodes last .. last + 3
    path = [origin]
    while True:
        node = path[-1]
        if node >= last:
            best, to = exits[node - last], None
        else:
            best, to = FAR, None
            for _, cost, head in arcs[node]:
                if cost + prices[head] < best:
                    best, to = cost + prices[head], head
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        elif to is None:
            return prices[origin]
        else:
            path.append(to)


def trace(
    arcs: list[list[tuple[str, int, int]]], exits: tuple[int, ...], prices: list[int], origin: int
) -> tuple[str, int]:
    """(ASCII-least letters of a shortest path, state it ends in), by tight
    arcs of converged prices."""
    last = len(arcs)
    dead: set[int] = set()
    path: list[tuple[int, int]] = [(origin, 0)]  # (node, next arc to try)
    letters: list[str] = []
    while True:
        node, k = path[-1]
        if node >= last:
            if prices[node] == exits[node - last]:
                return "".join(letters), node - last
        elif k < len(arcs[node]):
            path[-1] = (node, k + 1)
            letter, cost, head = arcs[node][k]
            if head not in dead and prices[node] == cost + prices[head]:
                path.append((head, 0))
                letters.append(letter)
            continue
        dead.add(node)
        path.pop()
        letters.pop()


def _leads(codes: bytes, a: int, b: int) -> bool:
    """The end state ``b`` can be reached from ``a``."""
    if b == 0:
        return a == 0
    if b == 1:
        keeps = any(INITIALS[c >> 2] == "s" and c & 3 < DUPLICATE_ROW for c in codes)
        return a == 1 or (a == 0 and keeps)
    return True


@functools.lru_cache(maxsize=50_000)
def block_costs(codes: bytes) -> tuple[int, ...]:
    """Costs from state a to state b (at 4 a + b), FAR where there is no way."""
    arcs = arcs_of(codes)
    out = [FAR] * 16
    for b in range(4):
        exits = tuple(0 if s == b else FAR for s in range(4))
        prices = [0] * (len(arcs) + 4)
        for a in range(4):
            if _leads(codes, a, b):
                out[4 * a + b] = auction(arcs, exits, prices, a)
    return tuple(out)


@functools.lru_cache(maxsize=50_000)
def block_edits(codes: bytes, exits: tuple[int, ...]) -> tuple[tuple[str, int], ...]:
    """(letters, end state) for every state at the block's start; ``exits``
    are the distances behind the block, less their least."""
    arcs = arcs_of(codes)
    prices = [0] * (len(arcs) + 4)
    out = []
    for a in range(4):
        auction(arcs, exits, prices, a)
        out.append(trace(arcs, exits, prices, a))
    return tuple(out)


def apply_edits(letters: str, state: int, roles: list, texts: list) -> list[tuple[str, str]]:
    """Turns (role, text) of a block entered in ``state``."""
    out, row = [], 0
    for e in letters:
        if e == "I":
            state = NEXT[state]
            out.append((NAMES[state], ""))
            continue
        if e == "K":
            state = KEPT[state][roles[row][0]]
            out.append((roles[row], texts[row]))
        elif e == "R":
            state = NEXT[state]
            out.append((NAMES[state], texts[row]))
        row += 1
    return out


# --- rows, in order, to blocks -----------------------------------------------


def damage(turns: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) of ``turns`` after the damage of
    the query contract, nulls of role and text as one space."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NULL))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    text = (
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    return (
        turns.select("conv_id", "turn", named("role").alias("role"), named("text").alias("text"))
        .where(kind != 0)
        .select(
            "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_"),
        )
        .drop("_")
    )


def _fault(new: Column) -> Column:
    visible = F.trim(F.col("text"), F.lit(SPACES))
    return (
        F.when(F.length(visible) == 0, BLANK_ROW)
        .when(~new, DUPLICATE_ROW)
        .when(~F.substring(visible, -1, 1).isin(".", "!", "?"), TRUNCATED_ROW)
        .otherwise(SOUND)
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies and the code of the first."""
    key = F.sha2("text", 256)
    copies = cut_lineage(
        turns.select(
            "conv_id", "turn", F.coalesce("role", F.lit(NULL)).alias("role"),
            F.coalesce("text", F.lit(NULL)).alias("text"),
        )
        .groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")),
        "turns",
    ).withColumn("key", key)
    # Nulls first: (false, null) is less than (true, any turn).
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = copies.groupBy(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key")
    ).agg(F.min(when).alias("_first"))
    same = [
        F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("role") == F.col("_role"),
        F.col("key") == F.col("_key"),
    ]
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS[1:]))
    initial = F.when(F.length("role") == 0, 0).otherwise(initial)
    return copies.join(firsts, same).select(
        "conv_id", "turn", "role", "text", "n",
        (4 * initial + _fault(F.col("_first").eqNullSafe(when))).alias("code"),
    )


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """(part, seq, conv_id, codes, roles, texts): blocks in the order of
    (part, seq), each of one conversation. Texts that are deleted for sure
    are not carried."""
    schema = T.StructType(
        [
            T.StructField("seq", T.LongType()),
            rows.schema["conv_id"],
            T.StructField("codes", T.BinaryType()),
            T.StructField("roles", T.ArrayType(T.StringType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = held = 0
        conv = None
        codes, roles, texts = bytearray(), [], []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([seq], pa.int64()), pa.array([conv], batch.schema.field(0).type),
                    pa.array([bytes(codes)], pa.binary()),
                    pa.array([roles], pa.list_(pa.string())),
                    pa.array([texts], pa.list_(pa.string())),
                ],
                names=schema.names,
            )

        for batch in batches:
            for c, role, text, n, code in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                for k in range(n):
                    if codes and (
                        c != conv or len(codes) >= block_rows or held >= BLOCK_BYTES
                    ):
                        yield flush()
                        seq, held = seq + 1, 0
                        codes, roles, texts = bytearray(), [], []
                    conv = c
                    again = code & 3 if code & 3 == BLANK_ROW else DUPLICATE_ROW
                    mine = code if k == 0 else (code & ~3) | again
                    carried = mine & 3 < DUPLICATE_ROW
                    codes.append(mine)
                    roles.append(role if carried else None)
                    texts.append(text if carried else None)
                    held += len(text) if carried else 0
        if codes:
            yield flush()

    order = ["conv_id", "turn", "role", "text"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (
        rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .select("conv_id", "role", "text", F.col("n").cast("long"), "code")
        .mapInArrow(run, schema)
    )
    return blocks.select(F.spark_partition_id().alias("part"), "*")


# --- passes over the blocks --------------------------------------------------

_BLOCK = ["conv_id", "part", "seq", "codes"]


def _rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _mapped(df: DataFrame, make, fields: str) -> DataFrame:
    """``df`` through ``make`` (rows of tuples in, rows of tuples out, as one
    stream per partition); the columns of ``_BLOCK`` come first in both."""
    kept = df.select(*_BLOCK).schema.fields
    schema = T.StructType([*kept, *T.DataType.fromDDL(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        stream = (
            row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)
        )
        held: list[tuple] = []
        for row in make(stream):
            held.append(row)
            if len(held) == 4096:
                yield _rows_to_batch(held, arrow)
                held = []
        yield _rows_to_batch(held, arrow)

    return df.mapInArrow(run, schema)


def _costs(stream):
    for conv, part, seq, codes in stream:
        yield conv, part, seq, codes, list(block_costs(bytes(codes)))


def _backwards(stream):
    """Blocks of a conversation from its last to its first: the distances
    behind each."""
    conv, behind, started = None, end_distances(), False
    for c, part, seq, codes, costs in stream:
        if not started or c != conv:
            conv, behind, started = c, end_distances(), True
        yield c, part, seq, codes, list(behind)
        behind = tuple(
            min(costs[4 * a + b] + behind[b] for b in range(4)) for a in range(4)
        )


def _edits(stream):
    for conv, part, seq, codes, behind in stream:
        least = min(behind)
        found = block_edits(bytes(codes), tuple(x - least for x in behind))
        yield (conv, part, seq, codes, [e for e, _ in found], [s for _, s in found])


def _count_faults(codes: bytes) -> list[int]:
    return [sum(c & 3 == f for c in codes) for f in (BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW)]


def _pairs(codes: bytes, before: int | None) -> int:
    """Illegal neighbours in a block and at its start."""
    initials = [INITIALS[c >> 2] for c in codes]
    if before is not None:
        initials.insert(0, INITIALS[before >> 2])
    return sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:], strict=False))


def _cost_of(letters: str, codes: bytes) -> int:
    row = cost = 0
    for e in letters:
        if e == "I":
            cost += INSERT
            continue
        if e == "D":
            cost += DELETE
        else:
            cost += (REROLE if e == "R" else 0) + (TRUNCATED if codes[row] & 3 else 0)
        row += 1
    return cost


def _forwards(stream):
    """Blocks of a conversation from its first to its last: the state each is
    entered in, its edits, and its share of every count."""
    conv, state, before, started, held = None, 0, None, False, None
    for c, part, seq, codes, letters, ends in stream:
        codes = bytes(codes)
        if not started or c != conv:
            if held:
                yield _closed(held, state)
            conv, state, before, started, held = c, 0, None, True, None
        if held:
            yield held
        edits = letters[state]
        held = (
            c, part, seq, codes, state, edits, *_count_faults(codes), _pairs(codes, before),
            _cost_of(edits, codes),
        )
        state, before = ends[state], codes[-1]
    if held:
        yield _closed(held, state)


def _closed(row: tuple, state: int) -> tuple:
    """The last block, with what is inserted at the end of the conversation."""
    return (*row[:5], row[5] + TAIL[state], *row[6:10], row[10] + INSERT * len(TAIL[state]))


def repair(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of the repaired conversations: conv_id, part, seq (the order of
    a conversation's blocks), audit (edit letters), turns (array of role and
    text), cost, blank, duplicate, truncated, illegal (shares of the block).

    ``turns``: conv_id, turn, role, text.
    """
    blocks = cut_lineage(_blocks(_ordered(turns), block_rows), "blocks")
    by_conv = lambda df, *order: df.repartition("conv_id").sortWithinPartitions("conv_id", *order)
    costs = _mapped(blocks.select(*_BLOCK), _costs, "costs array<bigint>")
    behind = _mapped(by_conv(costs, F.desc("part"), F.desc("seq")), _backwards, "behind array<bigint>")
    edits = _mapped(behind.repartition("part", "seq"), _edits, "letters array<string>, ends array<int>")
    chosen = _mapped(
        by_conv(edits, "part", "seq"), _forwards,
        "state int, audit string, blank bigint, duplicate bigint, truncated bigint,"
        " illegal bigint, cost bigint",
    ).drop("conv_id", "codes")
    found = blocks.join(chosen, ["part", "seq"])

    def run(stream):
        for conv, part, seq, codes, roles, texts, state, audit in stream:
            turns = apply_edits(audit, state, roles, texts)
            yield conv, part, seq, codes, audit, [{"role": r, "text": t} for r, t in turns]

    formed = _mapped(
        found.select(*_BLOCK, "roles", "texts", "state", "audit"), run,
        "audit string, turns array<struct<role:string,text:string>>",
    ).drop("codes")
    counts = chosen.select("part", "seq", "cost", "blank", "duplicate", "truncated", "illegal")
    return formed.join(counts, ["part", "seq"])


def summarise(repaired: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, the sums of its blocks, audit, and
    repaired_sha256 (hash of ``role:text`` lines). Conversations are hashed
    as a stream of blocks in order; only the letters are held."""
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    columns = ["conv_id", "part", "seq", *counts, "audit", "turns"]
    schema = T.StructType(
        [
            repaired.schema["conv_id"], *[T.StructField(c, T.LongType()) for c in counts],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        conv, state = None, None

        def row():
            return (conv, *state["sums"], "".join(state["audit"]), state["sha"].hexdigest())

        for batch in batches:
            done = []
            for c, _, _, *rest in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                *sums, audit, turns = rest
                if state is None or c != conv:
                    if state is not None:
                        done.append(row())
                    conv = c
                    state = {"sums": [0] * 5, "audit": [], "sha": hashlib.sha256(), "first": True}
                state["sums"] = [a + b for a, b in zip(state["sums"], sums, strict=True)]
                state["audit"].append(audit)
                for t in turns:
                    line = f"{t['role']}:{t['text']}"
                    state["sha"].update((line if state["first"] else "\n" + line).encode())
                    state["first"] = False
            yield _rows_to_batch(done, arrow)
        if state is not None:
            yield _rows_to_batch([row()], arrow)

    ordered = repaired.select(*columns).repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "part", "seq").mapInArrow(run, schema)


def gaps(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps): missing turn numbers between the least and the largest."""
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(missing, F.lit(0)).cast("bigint").alias("gaps"))


def repair_report(original: DataFrame, turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conversation of ``original`` (conv_id): conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of its
    rows in ``turns``."""
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = summarise(repair(turns, block_rows)).withColumnRenamed("conv_id", "_c")
    holes = gaps(turns).withColumnRenamed("conv_id", "_g")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        original.select("conv_id").distinct()
        .join(holes, F.col("conv_id").eqNullSafe(F.col("_g")), "left")
        .join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
        .select(
            "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
        )
    )

"""Conversation repair against dynamic programming over whole conversations."""

import hashlib
import re
from zlib import crc32

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelops.llm import chat_repair
from panelops.llm.queries import QUERIES

from .conftest import SMALL, rows_of

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        name = lambda v: " " if v is None else str(v)
        kind = crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def solve(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, sha) of ordered
    (role, text); suffixes from the last row to the first, strings compared."""
    seen, faults = set(), []
    for role, text in rows:
        shown = VISIBLE.findall(text)
        faults.append(
            "blank" if not shown else "duplicate" if (role, text) in seen
            else "truncated" if shown[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    other = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(3):
            for s in after:
                c, e, t = best[other[s]]
                best[s] = min(best[s], (c + 3, "I" + e, ((name[other[s]], ""), *t)))
        return best

    far = (10**9, "", ())
    best = inserted({"": (0, "", ()), "s": far, "u": far, "a": (0, "", ())})
    for (role, text), fault in zip(reversed(rows), reversed(faults), strict=True):
        here = {}
        for s in after:
            options = [(best[s][0] + 4, "D" + best[s][1], best[s][2])]
            if fault in ("", "truncated"):
                extra = 3 * (fault == "truncated")
                to = after[s].get(role[:1])
                if to:
                    c, e, t = best[to]
                    options.append((c + extra, "K" + e, ((role, text), *t)))
                c, e, t = best[other[s]]
                options.append((c + 3 + extra, "R" + e, ((name[other[s]], text), *t)))
            here[s] = min(options, key=lambda o: o[:2])
        best = inserted(here)
    cost, audit, turns = best[""]
    pairs = [(a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in zip(rows, rows[1:], strict=False)]
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(pairs), cost, audit, sha)


def report(rows, after):
    """Expected rows of the report; ``after``: rows after the damage."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(
            (r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])
        )
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *solve([(r[2], r[3]) for r in mine]))
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = rows_of(df)
    found = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query(spark, folder):
    rows = duckdb.sql(
        f"select conv_id, turn, role, text from read_parquet('{folder}/conversations.parquet')"
    ).fetchall()
    assert got(QUERIES["op12_chat_repair"](spark, folder)) == report(rows, damaged(rows))


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 1, "user", "Hi!"), (1, 2, "assistant", None),
    (None, None, "user", "A?"), (None, 5, "assistant", "B."), (None, None, None, None),
    (2, 3, "assistant", "x"), (2, 3, "assistant", "w"), (2, 1, "", "role."), (2, 9, "tool", "t."),
    (3, None, "user", "\t "), (3, None, "user", ""),
    (4, 0, "user", "long " * 100_000 + "."), (4, 1, "assistant", "long " * 100_000),
    (5, -7, "user", "ends\U0001f600."), (5, 2**40, "Assistant", "é!"),
]


@pytest.mark.parametrize("block_rows", [1, 2, 64])
def test_odd_rows(spark, block_rows):
    df = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("n", "code", "key", "part", "seq", "audit")})
    assert got(chat_repair.repair_report(df, df, block_rows)) == report(ODD, [
        (c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ODD
    ])
    assert got(chat_repair.repair_report(df, chat_repair.damage(df), block_rows)) == report(ODD, damaged(ODD))


def test_one_long_conversation_over_many_blocks(spark):
    rows = [
        (7, k // 2, ["user", "assistant", "user", "system", "tool"][(k * k) % 5], f"{k % 50}{'.?x'[k % 3]}")
        for k in range(700)
    ] + [(8, 0, "user", "u."), (8, 1, "assistant", "a.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(chat_repair.repair_report(df, df, block_rows=16)) == report(rows, rows)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rows_of(chat_repair.repair_report(df, df)) == []
    one = spark.createDataFrame([(1, 0, "user", "x.")], df.schema)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got(chat_repair.repair_report(one, df)) == {1: nothing}


ROLES = st.sampled_from(["system", "user", "assistant", "tool", ""])
TEXTS = st.sampled_from(["a.", "b!", "c", "", " ", "d?"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(ROLES, TEXTS), max_size=14), st.integers(1, 5))
def test_blocks_give_the_least_edits(rows, block_rows):
    seen, codes = set(), []
    for role, text in rows:
        shown = VISIBLE.findall(text)
        fault = 3 if not shown else 2 if (role, text) in seen else 1 if shown[-1] not in ".!?" else 0
        seen.add((role, text))
        codes.append(4 * max(0, "?sua".find(role[:1] or "?")) + fault)
    blocks = [bytes(codes[k : k + block_rows]) for k in range(0, len(codes), block_rows)]
    stream = ((1, 0, k, b, list(chat_repair.block_costs(b))) for k, b in reversed(list(enumerate(blocks))))
    behind = sorted(chat_repair._backwards(stream), key=lambda r: r[2])
    chosen = list(chat_repair._forwards(chat_repair._edits(iter(behind))))
    want = solve(rows)
    assert "".join(r[5] for r in chosen) == want[5]
    assert [sum(r[k] for r in chosen) for k in range(6, 11)] == list(want[:5])

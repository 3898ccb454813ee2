"""Reply trees to formatted conversations.

Input: one row per message (tree, node, parent, role, text, score). Paths from
a root to a leaf are enumerated by iterative self-joins with doubling:

1. up: ``J_k(v)`` is the message 2^k replies above v, with the score sum over
   those 2^k messages; ``J_{k+1} = J_k . J_k`` is one self-join. Rounds end
   when no message has an ancestor that far, so there are about log2(longest
   path) of them.
2. rank: a leaf's branch score is the sum over its path, read off the same
   tables; per tree the best ``branches`` leaves stay (ties: longer path,
   then the smaller leaf id).
3. down: starting from the chosen leaves, each round k = K..0 adds the
   message 2^k above every message found so far. A distance has one binary
   form, so every ancestor is found once, and the rows made are the messages
   of the chosen paths, no more.

Each chosen path becomes one conversation in a template with marked turns.
Inside texts and roles every control string (of the template and of other
common ones) gets a backslash after its first character, one more if it has
some already, which is undone by taking one away; nothing else of a text is
changed. The loss mask is a list of (start, end) code-point spans of the
formatted string, one per assistant text.

Native: DataFrame functions only. Rounds are written to the shared checkpoint
folder, so lineage stays short and lost executors cost one round. Joins are
keyed by (tree, node), which is unique on one side; a message with very many
replies is a hot key on the other, which AQE's skew join splits.

Defined cases: null role and text count as empty; a null tree id is a tree of
its own, messages without a node id are left out; a parent that does not
exist makes its message a root; messages of a reply cycle, and those that hang
from one, have no root and are left out; branches of equal score are ranked
by length, then leaf id; texts of any length are carried whole; repeated rows of a linear table are turns of their own, ordered
by (turn, role, text); an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelops.llm.common import let
from panelops.session import cut_lineage

# The template and the control strings of common templates.
TURN = "<|im_start|>"
END = "<|im_end|>\n"
CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
CONTROL_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL_ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """Roles stand on one line: percent signs and line ends are encoded."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    plain = unescape(role)
    return F.replace(F.replace(plain, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def linear_tree(turns: DataFrame) -> DataFrame:
    """Messages of a table of linear conversations (conv_id, turn, role,
    text): every turn answers the one before it. All scores are 0."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (
        turns.select("conv_id", "turn", "role", "text")
        .withColumn("node", F.row_number().over(order).cast("bigint"))
        .select(
            F.col("conv_id").alias("tree"), "node",
            F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
            "role", "text", F.lit(0.0).alias("score"),
        )
    )


def _jumps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """J_0, J_1, ...: (tree, node, up, gain) where ``gain`` is the score sum of
    the 2^k messages from ``node`` upwards, itself included; and the messages
    without a root, if there are any.

    A message that is as many replies above its first ancestor as its tree has
    messages has met one twice: it is on a reply cycle or hangs from one.
    """
    largest = messages.groupBy("tree").agg(F.count_distinct("node").alias("n"))
    largest = largest.agg(F.max("n")).first()[0] or 0
    parents = messages.select("tree", F.col("node").alias("parent"))
    linked = messages.where(F.col("parent").isNotNull()).select("tree", "node", "parent", "score")
    level = cut_lineage(
        # A parent id may be repeated in the input; one link per message.
        linked.join(parents.distinct(), ["tree", "parent"]).select(
            "tree", "node", F.col("parent").alias("up"), F.col("score").alias("gain")
        ),
        "jump",
    )
    found = []
    while not level.isEmpty():
        if 1 << len(found) >= largest:
            rootless = level.select("tree", "node").distinct()
            return [j.join(rootless, ["tree", "node"], "left_anti") for j in found], rootless
        found.append(level)
        far = level.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"),
                           F.col("gain").alias("_gain"))
        level = cut_lineage(
            level.join(far, ["tree", "up"]).select(
                "tree", "node", F.col("_up").alias("up"),
                (F.col("gain") + F.col("_gain")).alias("gain"),
            ),
            "jump",
        )
    return found, None


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Messages of the chosen root-to-leaf paths: tree, leaf, node, up
    (replies above the leaf, 0 for the leaf itself), branch_rank.

    ``branches``: how many leaves per tree, by descending branch score; None
    for all.
    """
    jumps, rootless = _jumps(messages)
    if rootless is not None:
        messages = messages.join(rootless, ["tree", "node"], "left_anti")
    parents = messages.where(F.col("parent").isNotNull()).select(
        "tree", F.col("parent").alias("node")
    ).distinct()
    leaves = messages.join(parents, ["tree", "node"], "left_anti").select(
        "tree", F.col("node").alias("leaf"), "score"
    )
    # Branch score and length: walk up by the largest jumps first.
    walk = leaves.select(
        "tree", "leaf", F.col("leaf").alias("node"), F.lit(0.0).alias("total"),
        F.lit(0).cast("bigint").alias("length"),
    )
    for k in range(len(jumps) - 1, -1, -1):
        step = jumps[k].select("tree", "node", F.col("up").alias("_up"), "gain")
        walk = walk.join(step, ["tree", "node"], "left").select(
            "tree", "leaf", F.coalesce("_up", "node").alias("node"),
            (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total"),
            (F.col("length") + F.when(F.col("_up").isNotNull(), 1 << k).otherwise(0)).alias(
                "length"
            ),
        )
    root_score = messages.select("tree", "node", F.col("score").alias("_root"))
    ranked = walk.join(root_score, ["tree", "node"]).withColumn(
        "branch_rank",
        F.row_number().over(
            Window.partitionBy("tree").orderBy(
                F.desc(F.col("total") + F.coalesce("_root", F.lit(0.0))), F.desc("length"), "leaf"
            )
        ),
    )
    if branches is not None:
        ranked = ranked.where(F.col("branch_rank") <= branches)
    found = cut_lineage(
        ranked.select(
            "tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("bigint").alias("up"),
            "branch_rank",
        ),
        "branches",
    )
    for k in range(len(jumps) - 1, -1, -1):
        step = jumps[k].select("tree", "node", F.col("up").alias("_up"))
        further = found.join(step, ["tree", "node"]).select(
            "tree", "leaf", F.col("_up").alias("node"), (F.col("up") + (1 << k)).alias("up"),
            "branch_rank",
        )
        found = cut_lineage(found.unionByName(further), "paths")
    return found


def format_conversations(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One row per chosen path: tree, leaf, branch_rank, n_turns, formatted,
    loss_spans. ``messages``: tree, node, parent, role, text, score."""
    # Joins need a key that is never null: a null tree is a tree of its own,
    # and its key is none of a string tree.
    messages = cut_lineage(
        messages.where(F.col("node").isNotNull()).select(
            F.col("tree").alias("_tree"),
            F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")).alias("tree"),
            "node", "parent", F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
        ),
        "messages",
    )
    head = F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n"))
    turns = (
        paths(messages.select("tree", "node", "parent", "score"), branches)
        .join(messages.select("tree", "node", "_tree", "role", "text"), ["tree", "node"])
        .select("tree", "_tree", "leaf", "branch_rank", "up", "role", head.alias("head"),
                escape(F.col("text")).alias("body"))
    )
    path = Window.partitionBy("tree", "leaf").orderBy(F.desc("up"))
    size = F.length("head") + F.length("body") + F.lit(len(END))
    placed = turns.withColumn("_end", F.sum(size).over(path)).withColumn(
        "_stop", F.col("_end") - F.lit(len(END))
    )
    learned = F.when(
        F.col("role") == LEARNED_ROLE,
        F.struct(
            (F.col("_stop") - F.length("body")).alias("start"), F.col("_stop").alias("end")
        ),
    )
    # One conversation is one string by definition, so its turns meet here.
    return (
        placed.groupBy("tree", "leaf")
        .agg(
            F.first("_tree").alias("_tree"),
            F.first("branch_rank").alias("branch_rank"),
            F.count(F.lit(1)).alias("n_turns"),
            F.sort_array(
                F.collect_list(
                    F.struct((-F.col("up")).alias("at"),
                             F.concat("head", "body", F.lit(END)).alias("turn"))
                )
            ).alias("_turns"),
            F.sort_array(F.collect_list(learned)).alias("loss_spans"),
        )
        .select(
            F.col("_tree").alias("tree"), "leaf", "branch_rank", "n_turns",
            F.array_join(F.transform("_turns", lambda t: t["turn"]), "").alias("formatted"),
            "loss_spans",
        )
    )


def parse_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.slice(F.split(formatted, r"\Q" + END + r"\E"), 1, F.size(
        F.split(formatted, r"\Q" + END + r"\E")) - 1)

    def turn(piece: Column) -> Column:
        line = F.locate("\n", piece)
        return F.struct(
            unescape_role(
                F.substring(piece, F.lit(len(TURN) + 1), line - (len(TURN) + 1))
            ).alias("role"),
            unescape(F.substring(piece, line + 1, F.length(piece))).alias("text"),
        )

    return F.transform(pieces, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between. Fixed-width
    code units make each span one slice instead of a scan."""

    def cut(raw: Column) -> Column:
        return F.transform(
            spans,
            lambda s: unescape(
                F.decode(
                    F.substring(
                        raw, (4 * s["start"] + 1).cast("int"),
                        (4 * (s["end"] - s["start"])).cast("int"),
                    ),
                    "UTF-32",
                )
            ),
        )

    return F.array_join(let(F.encode(formatted, "UTF-32"), cut), "")

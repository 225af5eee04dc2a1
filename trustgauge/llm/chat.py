"""Chat formatting: reply trees to ranked branches, each written as one conversation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgauge.llm.common import store

# The strings that mark turns in this template, and those of other common
# templates, which a text may not smuggle in either.
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
FOREIGN = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
CONTROL = (START, SEPARATOR, END, *FOREIGN)
ESCAPE = "\\"


def escape(text: Column) -> Column:
    """Break every control string with a backslash after its first character."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return reduce(
        lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + ESCAPE + c[1:])), CONTROL, doubled
    )


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def message_tree(messages: DataFrame) -> DataFrame:
    """Numbered rows of linear conversations as a tree: each turn answers the one before.

    Takes (conv_id, turn, role, text); gives (conv_id, node_id, parent_id, score, role, text).
    Turns that share a number are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return messages.withColumn("node_id", node).select(
        "conv_id", "node_id",
        F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
        F.lit(0.0).alias("score"), "role", "text",
    )


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """Level k leads from a node to its ancestor 2^k steps up, with the score on the way.

    Each level joins the one before with itself, so their number is the logarithm of the
    longest path; a cycle ends the climb after as many levels as the table could need.
    """
    level = store(
        nodes.where(F.col("parent_id").isNotNull()).select(
            "conv_id", "node_id", F.col("parent_id").alias("above"), F.col("score").alias("gain")
        )
    )
    most = nodes.count().bit_length()
    levels: list[DataFrame] = []
    while not level.isEmpty() and len(levels) <= most:
        levels.append(level)
        upper = level.select(
            "conv_id", F.col("node_id").alias("above"), F.col("above").alias("_above"),
            F.col("gain").alias("_gain"),
        )
        level = store(
            level.join(upper, ["conv_id", "above"]).select(
                "conv_id", "node_id", F.col("_above").alias("above"),
                (F.col("gain") + F.col("_gain")).alias("gain"),
            )
        )
    return levels


def best_paths(tree: DataFrame, top: int = 1) -> DataFrame:
    """The best ``top`` root-to-leaf paths of each conversation, one row per message.

    Takes (conv_id, node_id, parent_id, score); gives (conv_id, leaf_id, branch, depth,
    node_id), depth counted from the root. A branch scores the sum over its messages; ties go
    to the smaller leaf. A parent that does not exist makes a root, a null score counts 0,
    repeated nodes count once, nodes without conversation or id are left out, and messages on
    a cycle belong to no path.
    """
    keys = ["conv_id", "node_id"]
    known = tree.select(*keys, "parent_id", F.coalesce("score", F.lit(0.0)).alias("score")).where(
        F.col("conv_id").isNotNull() & F.col("node_id").isNotNull()
    )
    single = known.groupBy(*keys).agg(F.min(F.struct("parent_id", "score")).alias("m")).select(
        *keys, "m.parent_id", "m.score"
    )
    ids = single.select("conv_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("_is"))
    nodes = store(
        single.join(ids, ["conv_id", "parent_id"], "left").select(
            *keys, F.when(F.col("_is"), F.col("parent_id")).alias("parent_id"), "score"
        )
    )
    parents = nodes.where("parent_id is not null").select(
        "conv_id", F.col("parent_id").alias("node_id")
    )
    leaves = nodes.join(parents, keys, "left_anti").select("conv_id", F.col("node_id").alias("leaf_id"))
    levels = _levels(nodes)

    climb = leaves.select("conv_id", "leaf_id", F.col("leaf_id").alias("node_id"), F.lit(0.0).alias("total"))
    for level in reversed(levels):
        climb = climb.join(level, keys, "left").select(
            "conv_id", "leaf_id", F.coalesce("above", "node_id").alias("node_id"),
            (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total"),
        )
    roots = nodes.where("parent_id is null").select(*keys, "score")
    best = Window.partitionBy("conv_id").orderBy(F.col("score").desc(), "leaf_id")
    chosen = store(
        climb.join(roots, keys)
        .select("conv_id", "leaf_id", (F.col("total") + F.col("score")).alias("score"))
        .withColumn("branch", F.row_number().over(best))
        .where(F.col("branch") <= top)
        .select("conv_id", "leaf_id", "branch")
    )

    path = chosen.select("*", F.col("leaf_id").alias("node_id"), F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(levels))):
        here = F.struct("node_id", "up")
        there = F.struct(F.col("above").alias("node_id"), (F.col("up") + (1 << k)).alias("up"))
        path = path.join(levels[k], keys, "left").select(
            "conv_id", "leaf_id", "branch",
            F.explode(
                F.when(F.col("above").isNull(), F.array(here)).otherwise(F.array(here, there))
            ).alias("at"),
        ).select("conv_id", "leaf_id", "branch", "at.*")
    return path


def format_paths(paths: DataFrame, messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """Write each path as one conversation with a loss mask.

    ``messages`` has (conv_id, node_id, role, text), a row per node; nulls are empty. Gives
    (conv_id, leaf_id, branch, n_turns, formatted, loss_spans). A span is (start, length, turn,
    turn_start) in code points of ``formatted``, one for each text of the role ``learn``. Control
    strings inside roles and texts are escaped, so ``formatted`` can be read back exactly.
    """
    said = messages.select(
        "conv_id", "node_id", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEPARATOR))
    turns = paths.join(said, ["conv_id", "node_id"]).select(
        "conv_id", "leaf_id", "branch", (-F.col("up")).alias("place"), head.alias("head"),
        escape(F.col("text")).alias("body"), (F.col("role") == learn).alias("learn"),
    )
    size = F.length("head") + F.length("body") + len(END)
    order = Window.partitionBy("conv_id", "leaf_id").orderBy("place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumns(
        {
            "turn_start": F.coalesce(F.sum(size).over(before), F.lit(0)),
            "turn": F.row_number().over(order) - 1,
        }
    )
    piece = F.struct(
        "turn", F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(
            F.col("learn"),
            F.struct(
                (F.col("turn_start") + F.length("head")).alias("start"),
                F.length("body").cast("long").alias("length"),
                F.col("turn").cast("long").alias("turn"), "turn_start",
            ),
        ).alias("span"),
    )
    whole = turns.groupBy("conv_id", "leaf_id", "branch").agg(
        F.sort_array(F.collect_list(piece)).alias("p")
    )
    return whole.select(
        "conv_id", "leaf_id", "branch", F.size("p").cast("long").alias("n_turns"),
        F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("p", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def parse_turns(formatted: Column) -> Column:
    """Array of (role, text), read back from a formatted conversation."""
    pieces = F.split(formatted, END.replace("|", r"\|"))
    full = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(p: Column) -> Column:
        cut = F.instr(p, SEPARATOR)
        role = F.substring(p, F.lit(len(START) + 1), cut - (len(START) + 1))
        text = F.substring(p, cut + len(SEPARATOR), F.length(p))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(full, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, read turn by turn."""
    pieces = F.split(formatted, END.replace("|", r"\|"))
    texts = F.transform(
        spans,
        lambda s: unescape(
            F.substring(
                F.get(pieces, s["turn"].cast("int")),
                (s["start"] - s["turn_start"] + 1).cast("int"), s["length"].cast("int"),
            )
        ),
    )
    return F.array_join(texts, "")


def chat_format(tree: DataFrame, top: int = 1, learn: str = "assistant") -> DataFrame:
    """Reply trees (conv_id, node_id, parent_id, score, role, text) to formatted conversations.

    Nodes without conversation or id are left out, as in :func:`best_paths`, so a conversation without
    an id has no result; a null role or text is empty, a null score 0. Nodes repeated
    with all their columns count once; tied branches go to the smaller leaf. Texts of any length are
    kept whole. Other columns are ignored; an empty tree gives an empty result.
    """
    tree = store(tree.select("conv_id", "node_id", "parent_id", "score", "role", "text"))
    first = F.min(F.struct("role", "text"))
    messages = tree.groupBy("conv_id", "node_id").agg(first.alias("m")).select(
        "conv_id", "node_id", "m.role", "m.text"
    )
    return format_paths(best_paths(tree, top), messages, learn)

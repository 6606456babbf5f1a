"""Conversations from reply trees: paths by iterative self-joins, template, loss mask.

Built-in functions only. Joins jump twice as far each round, so a thread of n replies
takes about log2(n) rounds; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import materialize

#: The template's marks (fixed values). In a text ``<|`` becomes ``<\|``.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Reversible: no mark can occur in the result."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    # One backslash between < and | can only come from a mark: a text's own are doubled.
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("<\\n>"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """Written tables (tree, node, up): the ancestors 1, 2, 4, ... steps away, as far as there are any.

    Each joins the one before with itself and holds only nodes that have such an
    ancestor. A loop of parents is cut above its smallest node.
    """
    known = nodes.select("tree", F.col("node").alias("parent"))
    first = nodes.select("tree", "node", "parent").join(known, ["tree", "parent"])
    first = first.select("tree", "node", F.col("parent").alias("up"), F.least("node", "parent").alias("low"))
    tables = [materialize(first, "jumps")]
    longest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    while not tables[-1].isEmpty():
        last = tables[-1]
        if 2 ** (len(tables) - 1) > longest:  # only loops go on for longer than their tree has nodes
            cut = last.filter(F.col("node") == F.col("low")).select("tree", "node", F.lit(True).alias("_cut"))
            repaired = nodes.join(cut, ["tree", "node"], "left").withColumn(
                "parent", F.when(F.col("_cut").isNull(), F.col("parent"))
            )
            return _jumps(materialize(repaired.select(*nodes.columns), "loops-cut"))
        onward = last.select("tree", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("low").alias("_low"))
        doubled = last.join(onward, ["tree", "up"]).select(
            "tree", "node", F.col("_up").alias("up"), F.least("low", "_low").alias("low")
        )
        tables.append(materialize(doubled, "jumps"))
    return tables[:-1] or tables


def best_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """Members of the chosen root-to-leaf paths: (tree, branch, leaf, node, steps from the leaf).

    ``nodes``: tree (not NULL), node (unique in its tree), parent, score. A branch's score
    is the mean of its nodes' scores (NULL as 0); branches count from 1, the best first,
    ties to the smaller leaf; ``branches`` None keeps all. A node whose parent is missing
    is a root; a loop of parents is cut above its smallest node.
    """
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    nodes = materialize(nodes.select("tree", "node", "parent", score), "nodes")
    tables = _jumps(nodes)
    parents = tables[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = nodes.join(parents, ["tree", "node"], "left_anti")
    members = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("steps"))
    for k in range(len(tables) - 1, -1, -1):
        onward = members.join(tables[k].select("tree", "node", "up"), ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("steps") + F.lit(2**k)).alias("steps")
        )
        members = materialize(members.unionByName(onward), "paths")  # else the plan doubles each time
    scored = members.join(nodes.select("tree", "node", "score"), ["tree", "node"])
    order = Window.partitionBy("tree").orderBy(F.desc("_score"), "leaf")
    ranked = (
        scored.groupBy("tree", "leaf")
        .agg(F.avg("score").alias("_score"))
        .withColumn("branch", F.row_number().over(order))
    )
    if branches is not None:
        ranked = ranked.filter(F.col("branch") <= branches)
    return members.join(ranked.select("tree", "leaf", "branch"), ["tree", "leaf"])


def formatted(turns: DataFrame, keys: list[str], order: str = "position") -> DataFrame:
    """One row per conversation: its keys, ``formatted`` and ``loss_spans``.

    ``turns``: the keys, a unique position, role, text. Roles and texts that are NULL are
    empty. Loss spans (start, end in code points, end exclusive) cover what each
    assistant says, as it stands in the formatted text, and nothing of the marks.
    """
    role = escaped_role(F.coalesce("role", F.lit("")))
    text = escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        turns.withColumn("_head", head)
        .withColumn("_text", text)
        .withColumn("_turn", F.concat("_head", "_text", F.lit(END + "\n")))
        .withColumn("_at", F.coalesce(F.sum(F.length("_turn")).over(before), F.lit(0)) + F.length("_head"))
    )
    collected = placed.groupBy(*keys).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.col(order).alias("position"),
                    F.col("_turn").alias("turn"),
                    (F.coalesce("role", F.lit("")) == TRAINED_ROLE).alias("trained"),
                    F.col("_at").alias("start"),
                    (F.col("_at") + F.length("_text")).alias("end"),
                )
            )
        ).alias("_turns")
    )
    return collected.select(
        *keys,
        F.array_join(F.transform("_turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(
            F.filter("_turns", lambda t: t["trained"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))
        ).alias("loss_spans"),
    )


def conversations(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """Chosen paths of reply trees as conversations: tree, branch, formatted, loss_spans.

    ``nodes``: tree, node, parent, score, role, text; see ``best_paths``. All rows of a
    chosen path are formatted from the root on; an empty table gives an empty one.
    """
    nodes = materialize(nodes.select("tree", "node", "parent", "score", "role", "text"), "replies")
    paths = best_paths(nodes, branches)
    turns = paths.join(nodes.select("tree", "node", "role", "text"), ["tree", "node"]).withColumn(
        "position", -F.col("steps")
    )
    return formatted(turns, ["tree", "branch"])


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation, unescaped."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p: p != "")

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        rest = F.substr(part, F.length(role) + 2)
        text = F.substr(rest, F.lit(1), F.length(rest) - len(END) - 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """What stands under the loss mask, unescaped, nothing between the spans."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: unescaped(
                F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
        "",
    )

"""Chat formatting of reply trees: root-to-leaf paths as one conversation each.

Paths are enumerated by self-joins that double their reach: after round k a
path holds the 2^k nodes nearest its leaf, so a tree of depth d takes log2(d)
joins. Everything is DataFrame code; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.llm.common import materialize

TURN_START, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"

#: Fixed values of the template: what is written for what. The backslash comes
#: first when writing and last when reading, so the codes cannot be confused.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"), ("<turn>", "\\s"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, codes=ESCAPES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes=ESCAPES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reply_paths(nodes: DataFrame, conv: str, node: str, parent: str, score: str, top: int | None = None) -> DataFrame:
    """One row per node of every chosen path: ``conv, leaf, path_rank, path_score, step, node``.

    ``nodes`` has one row per (conv, node); a node whose parent is null or
    absent is a root. A path's score is the mean score of its nodes (null: 0);
    paths of a conversation rank by score, then by smaller leaf, and ``top``
    keeps the best so many (all by default). Nodes that lead into a circle of
    parents reach no root and are on no path.
    """
    known = nodes.select(F.col(conv).alias("c"), F.col(node).alias("n"), F.col(parent).alias("p"), F.col(score).cast("double").alias("s"))
    known = materialize(known, "chat-nodes")
    parents = known.where("p IS NOT NULL").select("c", F.col("n"), F.col("p").alias("a"))
    jump = materialize(parents.join(known.select("c", F.col("n").alias("a")), ["c", "a"]).select("c", "n", "a"), "chat-jump")
    leaves = known.select("c", "n").join(jump.select("c", F.col("a").alias("n")), ["c", "n"], "left_anti")
    path = leaves.select("c", F.col("n").alias("leaf"), "n", F.lit(0).cast("long").alias("up"))
    # No path has more nodes than its conversation: the bound that ends circles.
    most = known.groupBy("c").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while reach < most and jump.limit(1).count():
        further = path.join(jump, ["c", "n"]).select("c", "leaf", F.col("a").alias("n"), (F.col("up") + reach).alias("up"))
        path = materialize(path.union(further), "chat-path")
        next_jump = jump.join(jump.select("c", F.col("n").alias("a"), F.col("a").alias("b")), ["c", "a"])
        jump = materialize(next_jump.select("c", "n", F.col("b").alias("a")), "chat-jump")
        reach *= 2
    scored = path.join(known.select("c", "n", "s", "p"), ["c", "n"])
    roots = known.select("c", "n").join(parents.join(known.select("c", F.col("n").alias("a")), ["c", "a"]).select("c", "n"), ["c", "n"], "left_anti")
    totals = scored.groupBy("c", "leaf").agg(F.avg(F.coalesce("s", F.lit(0.0))).alias("path_score"))
    rooted = path.join(roots, ["c", "n"], "left_semi").select("c", "leaf").distinct()
    order = Window.partitionBy("c").orderBy(F.desc("path_score"), "leaf")
    ranked = totals.join(rooted, ["c", "leaf"]).withColumn("path_rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("path_rank") <= top)
    return path.join(ranked, ["c", "leaf"]).select(
        F.col("c").alias(conv), "leaf", "path_rank", "path_score", (-F.col("up")).alias("step"), F.col("n").alias(node)
    )


def format_paths(turns: DataFrame, conv: str, leaf: str = "leaf", loss_role: str = "assistant") -> DataFrame:
    """One row per (conv, leaf): ``n_turns``, ``formatted``, ``loss_spans``.

    ``turns`` has ``step``, ``role`` and ``text`` (null: empty). A turn reads
    ``### role: text</turn>`` and a line feed, with control strings inside role
    and text escaped. ``loss_spans`` are (start, length) in code points of
    ``formatted``, one for each text of ``loss_role``, markers left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN_START), escape(role, ROLE_ESCAPES), F.lit(ROLE_END))
    rows = turns.select(conv, leaf, "step", head.alias("_head"), escape(text).alias("_text"), (role == loss_role).alias("_loss"))
    rows = rows.withColumn("_size", F.length("_head") + F.length("_text") + len(TURN_END))
    before = Window.partitionBy(conv, leaf).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_size").over(before), F.lit(0)) + F.length("_head")
    rows = rows.withColumn("_start", start.cast("long"))
    made = rows.groupBy(conv, leaf).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "step",
                    F.concat("_head", "_text", F.lit(TURN_END)).alias("block"),
                    "_loss",
                    F.struct(F.col("_start").alias("start"), F.length("_text").cast("long").alias("length")).alias("span"),
                )
            )
        ).alias("_turns")
    )
    return made.select(
        conv,
        leaf,
        F.size("_turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("_turns", lambda t: t["block"]), "").alias("formatted"),
        F.transform(F.filter("_turns", lambda t: t["_loss"]), lambda t: t["span"]).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    blocks = F.split(formatted, TURN_END)
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)

    def turn(block: Column) -> Column:
        body = F.substring(block, F.lit(len(TURN_START) + 1), F.length(block))
        role = F.substring_index(body, ROLE_END, 1)
        text = F.substring(body, F.length(role) + len(ROLE_END) + 1, F.length(body))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))

    return F.transform(blocks, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, joined in order."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Conversations whose rows follow each other by turn, as reply trees of one path.

    Rows are numbered by turn (nulls first); rows of the same turn by role and
    text, so repeated rows stay and have a defined order.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        "conv_id", F.row_number().over(order).alias("node"), "role", "text"
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def format_conversations(nodes: DataFrame, conv: str = "conv_id", node: str = "node", parent: str = "parent", score: str | None = None, top: int | None = None) -> DataFrame:
    """Reply trees (``conv, node, parent, role, text``) to formatted conversations, best path first.

    Rows with a null conversation or node id take part in none. An empty table
    gives an empty result; further columns are ignored.
    """
    rows = nodes.where(F.col(conv).isNotNull() & F.col(node).isNotNull())
    rows = rows.withColumn("_score", F.lit(0.0) if score is None else F.col(score).cast("double"))
    rows = materialize(rows.select(conv, node, parent, "_score", "role", "text"), "chat-rows")
    paths = reply_paths(rows, conv, node, parent, "_score", top)
    turns = paths.join(rows.select(conv, node, "role", "text"), [conv, node])
    best = paths.where("step = 0").select(conv, "leaf", "path_rank", "path_score")
    return format_paths(turns, conv).join(best, [conv, "leaf"])


def digest(formatted: DataFrame) -> DataFrame:
    """Contract columns, all read back from ``formatted`` and its mask."""
    turns = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = formatted.select("conv_id", "formatted", turns.alias("_turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("_loss"))
    return loss.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("_turns", ""), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )

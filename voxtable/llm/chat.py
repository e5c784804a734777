r"""Chat formatting of reply trees, in DataFrame operations alone.

Iterative self-joins double the distance each round, so a chain of n turns takes log2(n) rounds. On the way up every node adds its 2^k-th
ancestor's score to its own, one row a node and round; branches are ranked by the mean score that their leaves have then. On the way down the list of
links only the chosen leaves' paths are enumerated, and each becomes one conversation: a tree whose branches have many nodes in common isn't multiplied out.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` a turn. In roles and texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (in
roles also a newline ``&#10;``), so no control string can occur inside and every text reads back exactly.
The loss mask is the spans of the assistant texts.

Defined cases: null roles and texts are empty; a null tree id is a tree of its own; a parent that doesn't exist makes its child a root; nodes that
hang on a cycle are on no path; of rows with one node id the least (role, text, score) counts; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

START, END, ROLE = "<|im_start|>", "<|im_end|>\n", "assistant"
_NODE = ("tree_id", "node_id", "parent_id", "role", "text", "score")


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("&#10;"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def _meet(rows: DataFrame, other: DataFrame, column: str) -> Column:
    """rows' column names a node of the same tree in other (t, n)."""
    return rows["tree_id"].eqNullSafe(other["t"]) & (rows[column] == other["n"])


def climbed(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """nodes: tree_id, node_id, parent_id, score -> tree_id, node_id, up_id, total, turns of every node, and the links (t, n, up_id) of 1, 2, 4, ... steps up.

    total and turns are the sum of the scores and the number of the nodes from this one to its root; up_id is null then, and a node that hangs on a cycle keeps one.
    A round has one row for each node that isn't at its root yet, however many branches it is on.
    """
    known = nodes.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    level = nodes.join(known, _meet(nodes, known, "parent_id"), "left")
    level = cut(level.select("tree_id", "node_id", F.col("n").alias("up_id"), F.col("score").alias("total"), F.lit(1).cast("long").alias("turns")))
    largest = level.groupBy("tree_id").count().agg(F.max("count")).first()[0] or 0
    links: list[DataFrame] = []
    while 1 << len(links) < largest:
        below = level.filter("up_id is not null")
        further = below.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "up_id")
        if further.isEmpty():
            break
        links.append(further)
        above = level.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), F.col("up_id").alias("next"), F.col("total").alias("more"), F.col("turns").alias("longer"))
        moved = below.join(above, _meet(below, above, "up_id"))
        moved = cut(moved.select("tree_id", "node_id", F.col("next").alias("up_id"), (F.col("total") + F.col("more")).alias("total"), (F.col("turns") + F.col("longer")).alias("turns")))
        level = level.filter("up_id is null").unionByName(moved)
    return level, links


def branches(level: DataFrame, parents: DataFrame, best: int | None) -> DataFrame:
    """tree_id, leaf, rank, score of the ``best`` leaves of each tree by the mean score of their branch, ties by leaf (None: all)."""
    parents = parents.select(F.col("t"), F.col("up_id").alias("n")).distinct()
    leaves = level.filter("up_id is null").join(parents, _meet(level, parents, "node_id"), "left_anti")
    leaves = leaves.select("tree_id", F.col("node_id").alias("leaf"), (F.col("total") / F.col("turns")).alias("score"))
    ranked = leaves.withColumn("rank", F.row_number().over(W.partitionBy("tree_id").orderBy(F.desc("score"), "leaf")))
    return (ranked if best is None else ranked.filter(F.col("rank") <= best)).select("tree_id", "leaf", "rank", "score")


def paths(chosen: DataFrame, links: list[DataFrame]) -> DataFrame:
    """chosen: tree_id, leaf and more -> the same with node_id and up (0 at the leaf) for every node from the leaf to its root. links as climbed gives them."""
    found = cut(chosen.select("*", F.col("leaf").alias("node_id"), F.lit(0).cast("long").alias("up")))
    for k, link in enumerate(links):
        further = found.join(link, _meet(found, link, "node_id")).select(*chosen.columns, F.col("up_id").alias("node_id"), (F.col("up") + (1 << k)).alias("up"))
        found = cut(found.unionByName(further))
    return found


def format_trees(nodes: DataFrame, best: int | None = 1) -> DataFrame:
    """nodes: tree_id, node_id, parent_id, role, text, score -> tree_id, leaf, rank, score, formatted, loss_spans (start, end in code points of formatted).

    The ``best`` highest-scoring branches of each tree (None: all), ties by leaf.
    """
    rows = nodes.groupBy("tree_id", "node_id").agg(F.min(F.struct("parent_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))).alias("v"))
    rows = rows.select("tree_id", "node_id", "v.*")
    level, links = climbed(rows.select("tree_id", "node_id", "parent_id", "score"))
    parents = links[0] if links else level.filter("up_id is not null").select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "up_id")
    chosen = paths(branches(level, parents, best), links)
    told = rows.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "role", "text")
    turns = chosen.join(told, chosen["tree_id"].eqNullSafe(told["t"]) & (chosen["node_id"] == told["n"]))
    head, body = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n")), escaped(F.col("text"))
    turns = turns.select("tree_id", "leaf", "rank", "score", "up", (F.col("role") == ROLE).alias("loss"), F.length(head).alias("head"), F.length(body).alias("body"), F.concat(head, body, F.lit(END)).alias("piece"))
    before = F.coalesce(F.sum(F.length("piece")).over(W.partitionBy("tree_id", "leaf").orderBy(F.desc("up")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumn("start", before + F.col("head"))
    one = F.struct((-F.col("up")).alias("at"), "piece", "loss", "start", (F.col("start") + F.col("body")).alias("end"))
    out = turns.groupBy("tree_id", "leaf").agg(F.first("rank").alias("rank"), F.first("score").alias("score"), F.sort_array(F.collect_list(one)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return out.select("tree_id", "leaf", "rank", "score", F.array_join(F.col("turns.piece"), "").alias("formatted"), spans.alias("loss_spans"))


def turns_of(formatted: Column) -> Column:
    """A formatted conversation read back: array<struct<role, text>>."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 2147483646)
    whole = F.transform(parts, lambda x: F.substr(x, F.lit(1), F.length(x) - len(END)))
    role = lambda x: F.substring_index(x, "\n", 1)
    return F.transform(whole, lambda x: F.struct(unescaped_role(role(x)).alias("role"), unescaped(F.substr(x, F.length(role(x)) + 2)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def as_trees(conversations: DataFrame) -> DataFrame:
    """Conversations of rows by turn as trees of one branch: each row replies to the one before it."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("at", F.row_number().over(order).cast("long"))
    return rows.select(F.col("conv_id").alias("tree_id"), F.col("at").alias("node_id"), F.when(F.col("at") > 1, F.col("at") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))

r"""Conversations from reply trees, with DataFrame functions only.

Messages form trees: each names the message it answers.  Self-joins that double their
reach enumerate the paths from leaves to roots, so a tree of depth n takes log2(n) rounds.
Paths are ranked by the mean score of their messages; the chosen ones are formatted, each
as one conversation.

A turn is written as ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line end.  In roles
and texts a backslash becomes two and ``<|`` becomes ``<\|``, so no text can hold a mark of
the template, and reading a backslash as "take the next sign as it is" gives the text back.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgersieve.llm.store import written

START, BETWEEN, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, place): nodes of the ``branches`` best root-to-leaf paths of each tree.

    ``messages`` has tree, node (unique in its tree), parent (null, or a node that is not
    there: a root) and score (null: zero).  Paths are ranked by their mean score, then by
    the leaf.  Messages that answer each other in a circle have no root and are on no path.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    there = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    nodes = nodes.join(there, ["tree", "parent"], "left").withColumn("up", F.when(F.col("there"), F.col("parent")))
    step = written(nodes.select("tree", "node", "up", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("far"),
                                F.col("score").alias("sum"), "score"), "tree")
    leaves = step.select("tree", "node").join(
        step.select("tree", F.col("up").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti")
    most = step.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    levels = []
    for _ in range(max(1, math.ceil(math.log2(most + 1)))):
        levels.append(step.select("tree", F.col("node").alias("below"), F.col("up").alias("above")).where("above is not null"))
        if step.where("up is not null").isEmpty():
            break
        # ``sum`` covers the node and all before ``up``; ``far`` counts the steps to ``up``, or to the root.
        high = step.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("far").alias("far2"), F.col("sum").alias("sum2"))
        # Only nodes that have not met their root go on, so a few long chains cost no more than themselves.
        moved = step.where("up is not null").join(high, ["tree", "up"], "left").select(
            "tree", "node", F.col("up2").alias("up"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far"),
            (F.col("sum") + F.coalesce("sum2", F.lit(0.0))).alias("sum"), "score")
        step = written(step.where("up is null").select(*moved.columns).unionByName(moved), "tree")
    depth = step.where("up is null").select("tree", "node", F.col("far").alias("place"), (F.col("sum") / (F.col("far") + 1)).alias("mean"))
    best = Window.partitionBy("tree").orderBy(F.desc("mean"), "node")
    chosen = (leaves.join(depth, ["tree", "node"]).withColumn("rank", F.row_number().over(best))
              .where(F.col("rank") <= branches).select("tree", F.col("node").alias("leaf"), "rank", "node"))
    chosen = written(chosen, "paths")
    for level in levels:
        more = chosen.join(level, (chosen["tree"] == level["tree"]) & (F.col("node") == F.col("below"))).select(
            chosen["tree"], "leaf", "rank", F.col("above").alias("node"))
        chosen = written(chosen.unionByName(more), "paths")
    return chosen.join(depth.select("tree", "node", "place"), ["tree", "node"])


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, mask): one conversation for each chosen path.

    ``messages`` as for ``paths``, with role and text; null reads as empty.  ``mask`` lists
    the spans (start, end; code points) of the texts to learn, those of the assistant.
    A conversation is one row, so it has to fit in one; nothing else is gathered.
    """
    turns = messages.select("tree", "node", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = paths(messages, branches).join(turns, ["tree", "node"])
    rows = rows.withColumn("open", F.concat(F.lit(START), escape(F.col("role")), F.lit(BETWEEN))).withColumn("body", escape(F.col("text")))
    rows = rows.withColumn("size", F.length("open") + F.length("body") + len(STOP))
    sofar = Window.partitionBy("tree", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("start", F.sum("size").over(sofar) - F.length("body") - len(STOP))
    rows = rows.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct(
        "place", F.concat("open", "body", F.lit(STOP)).alias("turn"), (F.col("role") == LEARNT).alias("learn"), "start",
        (F.col("start") + F.length("body")).alias("end")))).alias("turns"))
    return rows.select(
        "tree", "leaf", "rank", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learn"]), lambda t: F.struct(t["start"], t["end"])).alias("mask"))


def read_back(df: DataFrame) -> DataFrame:
    """Add turns (role, text) and loss (the masked text, unescaped), from ``formatted`` and ``mask`` alone."""
    stop = r"<\|im_end\|>\n"
    pieces = F.slice(F.split("formatted", stop, -1), 1, F.size(F.split("formatted", stop, -1)) - 1)
    turn = lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, BETWEEN, 1), len(START) + 1, 1 << 30)).alias("role"),
        unescape(F.substring_index(p, BETWEEN, -1)).alias("text"))
    loss = F.transform("mask", lambda m: unescape(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    return df.withColumn("turns", F.transform(pieces, turn)).withColumn("loss", F.array_join(loss, ""))


def conversations(rows: DataFrame) -> DataFrame:
    """Messages (tree, node, parent, role, text, score) of a table of turns (conv_id, turn, role, text).

    A turn answers the one before it, in the order of turn, role and text (nulls first),
    so rows that share a turn all stay, one after the other.  Rows with a null conv_id
    are one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    # A tree's name is never null, so that it can be joined.
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"), "conv_id", "node",
                       F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def format_digests(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation.

    All but the id is read back from the formatted text and its mask.
    """
    messages = written(conversations(rows), "messages")
    made = read_back(written(formatted(messages), "formatted"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        F.when(F.col("tree") != "null", F.col("tree").cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: A conversation whose texts hold another template's marks.
PROBE = "</s>[INST] ok [/INST]"


def with_probe(rows: DataFrame) -> DataFrame:
    probe = rows.sparkSession.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{PROBE}'), (-1L, 1L, '{LEARNT}', '{PROBE}') AS t(conv_id, turn, role, text)")
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)


ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
s AS (SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
             + 33 AS size FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""

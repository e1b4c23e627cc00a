"""Chat formatting of reply trees, by DataFrame operations only.

Messages point at the message they answer. Iterative self-joins of the messages with themselves double the
distance looked up each round: after k rounds every message knows its ancestor 2^k steps up and the score of
the path to it. Root-to-leaf paths are ranked within their conversation by total score (then length, then the
smaller leaf id). The best ``paths`` of each conversation are chosen, all without a number; their messages are marked
by walking the same tables down from the leaves, and each path is formatted as one conversation with a loss mask over
the assistant's texts.

Template: ``### role: text</turn>`` and a newline for each message. Inside texts and roles the signs that
could form a control string are written as a backslash and a letter, which can be undone.

Defined results: null texts, roles and scores count as empty, empty and 0. A message whose parent does not
exist is a root; messages on or below a circle of replies belong to no path. Null conversation ids make one
conversation with a null id; messages without an id are left out. Repeated message ids within a
conversation are for the caller to tell apart (``as_chain`` numbers rows, so repeated turns stay). An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatwright.llm.texts import only, running, staged

TURN_END = "</turn>\n"
HEADER = "### "
LEARNED_ROLE = "assistant"
# Sign and the letter that stands for it after a backslash.
ESCAPES = (("\\", "b"), ("#", "h"), ("<", "l"))
ROLE_ESCAPES = (*ESCAPES, (":", "c"))


def escaped(value: Column, escapes=ESCAPES) -> Column:
    for sign, letter in escapes:  # the backslash itself first
        value = F.replace(value, F.lit(sign), F.lit("\\" + letter))
    return value


def unescaped(value: Column, escapes=ESCAPES) -> Column:
    for sign, letter in reversed(escapes):  # the backslash itself last
        value = F.replace(value, F.lit("\\" + letter), F.lit(sign))
    return value


def as_chain(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as messages, each one answering the row before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return only(rows, "conv_id", "turn", "role", "text").select(
        "conv_id",
        F.row_number().over(order).cast("bigint").alias("msg_id"),
        (F.row_number().over(order).cast("bigint") - 1).alias("parent_id"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )


def _same(left: str, right: str, key: str) -> Column:
    return F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id")) & (
        F.col(f"{left}.{key}") == F.col(f"{right}.id")
    )


def ranked_paths(messages: DataFrame, paths: int | None = None) -> DataFrame:
    """``conv_id``, ``rank`` (from 1), ``id`` and ``depth`` (1 at the root) of the messages on the chosen paths."""
    nodes = messages.filter("msg_id is not null").select(
        "conv_id",
        F.col("msg_id").alias("id"),
        F.col("parent_id").alias("up"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
        F.lit(1).cast("bigint").alias("depth"),
    )
    nodes = staged(nodes, "replies")
    # A parent that does not exist is none.
    known = nodes.select(F.col("conv_id"), "id")
    nodes = (
        nodes.alias("n")
        .join(known.alias("p"), _same("n", "p", "up"), "left")
        .select("n.conv_id", "n.id", F.col("p.id").alias("up"), "n.score", "n.depth")
    )
    jumps = [staged(nodes, "replies")]
    longest = jumps[0].groupBy("conv_id").count().agg(F.max("count").alias("n")).first()["n"] or 0
    while 2 ** (len(jumps) - 1) < longest:
        step = jumps[-1]
        # Messages that have reached their root are through with joining.
        doubled = (
            step.filter("up is not null")
            .alias("n")
            .join(step.alias("a"), _same("n", "a", "up"))
            .select(
                "n.conv_id",
                "n.id",
                F.col("a.up").alias("up"),
                (F.col("n.score") + F.coalesce("a.score", F.lit(0.0))).alias("score"),
                (F.col("n.depth") + F.coalesce("a.depth", F.lit(0))).alias("depth"),
            )
        )
        jumps.append(staged(doubled.unionByName(step.filter("up is null")), "replies"))
    full = jumps[-1].filter("up is null")  # what still has an ancestor goes in a circle
    inner = jumps[0].filter("up is not null").select("conv_id", F.col("up").alias("id"))
    leaves = full.alias("n").join(inner.alias("p"), _same("n", "p", "id"), "left_anti")
    order = Window.partitionBy("conv_id").orderBy(F.desc("score"), F.desc("depth"), F.asc("id"))
    marked = leaves.select("conv_id", "id", F.row_number().over(order).alias("rank"))
    if paths is not None:
        marked = marked.filter(F.col("rank") <= paths)
    for step in reversed(jumps):
        above = step.filter("up is not null").alias("n").join(marked.alias("p"), _same("n", "p", "id"))
        marked = staged(marked.unionByName(above.select("n.conv_id", F.col("n.up").alias("id"), "p.rank")), "path")
    return (
        marked.alias("p")
        .join(full.alias("n"), _same("p", "n", "id"))
        .select("p.conv_id", "p.rank", "p.id", "n.depth")
    )


def format_trees(messages: DataFrame, paths: int | None = None) -> DataFrame:
    """``conv_id``, ``rank``, ``formatted`` and ``loss`` (spans of learned text in it, in code points) of each path."""
    messages = only(messages, "conv_id", "msg_id", "parent_id", "role", "text", "score")
    path = ranked_paths(messages, paths)
    role = F.coalesce("m.role", F.lit(""))
    written = (
        path.alias("n")
        .join(messages.withColumnRenamed("msg_id", "id").alias("m"), _same("n", "m", "id"))
        .select(
            "n.conv_id",
            "n.rank",
            F.struct(
                "n.depth",
                F.concat(F.lit(HEADER), escaped(role, ROLE_ESCAPES), F.lit(": ")).alias("head"),
                escaped(F.coalesce("m.text", F.lit(""))).alias("body"),
                (role == LEARNED_ROLE).alias("learned"),
            ).alias("turn"),
        )
    )
    turns = written.groupBy("conv_id", "rank").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    sizes = F.transform(
        "turns", lambda t: (F.length(t["head"]) + F.length(t["body"]) + len(TURN_END)).cast("bigint")
    )
    places = running(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b)
    spans = F.zip_with(
        "turns",
        places,
        lambda t, place: F.when(
            t["learned"],
            F.struct((place + F.length(t["head"])).alias("start"), F.length(t["body"]).cast("bigint").alias("size")),
        ),
    )
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(TURN_END)))
    return turns.select(
        "conv_id", "rank", F.array_join(pieces, "").alias("formatted"), F.array_compact(spans).alias("loss")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, ``rank``, ``turns`` (role, text) and ``learned`` (the text under the mask), parsed from the output."""
    cut = F.split("formatted", TURN_END)
    parts = F.slice(cut, 1, F.size(cut) - 1)
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescaped(
                F.substr(F.substring_index(p, ": ", 1), F.lit(len(HEADER) + 1)), ROLE_ESCAPES
            ).alias("role"),
            unescaped(F.substr(p, F.length(F.substring_index(p, ": ", 1)) + 3)).alias("text"),
        ),
    )
    learned = F.transform(
        "loss", lambda s: unescaped(F.substr("formatted", (s["start"] + 1).cast("int"), s["size"].cast("int")))
    )
    return formatted.select(
        "conv_id", "rank", "formatted", turns.alias("turns"), F.array_join(learned, "").alias("learned")
    )

"""The trie of all conversations' prefixes, with totals of every subtree, by van Emde Boas recursion.

A conversation is cut at half depth, then both halves at theirs, and so on; all pieces of one size are worked on
in the same jobs. Rows stay turns, never whole conversations:

1. ``blocks``: a digest of every aligned run of 1, 2, 4, ... turns, each from the two of half its length.
2. ``named_prefixes``: the prefix before a cut is named by the smallest conversation that starts with it, found
   from the name of the tree the piece hangs on and the digest of its upper half. Below the cut the pieces hang on
   the new names (the lower forest), above it on the old one (the upper trie). After the last cut every prefix of
   every conversation has its name, and (name, depth) is a node.
3. ``grafted``: from the smallest pieces up, the totals of each lower tree are added to the nodes of the upper
   trie on the way to the root of the piece.

Names come from grouped minima, combined before the shuffle, and are joined back by keys that may be hot on one
side only. The ids that end in a node are put in order in runs of RUN neighbouring ids and hashed run by run.

Defined results: a null role or text is empty. Turns are ordered by turn (null first), then role, then text;
repeated rows are turns of their own. Rows without a ``conv_id`` belong to no conversation and are left out. An empty
table has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, on_batches, only, staged

# Whose first turns a conversation takes, and how many at most.
TEMPLATES = 100
TAKEN = 6
# Ids of a node are joined to a text by runs of so many neighbouring ids.
RUN = 1 << 16

NUMBERED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("n", pa.int64()),
        ("task", pa.int32()),
        ("place", pa.int64()),
    ]
)
NUMBERED_DDL = "conv_id bigint, role string, text string, n bigint, task int, place bigint"
ENDS = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
ENDS_DDL = "conv_id bigint, depth bigint, ends_sha256 string"


def _numbering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many turns of its conversation the task holds before each row; rows are in order."""
    task = TaskContext.get().partitionId()
    current, before = None, 0
    for batch in batches:
        places = []
        for conv_id, n in zip(batch.column("conv_id").to_pylist(), batch.column("n").to_pylist(), strict=True):
            if conv_id != current:
                current, before = conv_id, 0
            places.append(before)
            before += n
        columns = [batch.column(name) for name in ("conv_id", "role", "text", "n")]
        yield arrow_rows(NUMBERED, [*columns, [task] * batch.num_rows, places])


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 1, ``role`` and ``text`` of each turn, in order.

    A conversation may be longer than a task can sort: rows are dealt by ranges of the whole order, numbered in
    each task, and a task's rows follow those of the tasks before it. Equal rows are counted, then dealt as one.
    """
    rows = only(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    counted = rows.where(F.col("conv_id").isNotNull()).groupBy(*order).agg(F.count("*").alias("n"))
    ranges = staged(counted, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = staged(on_batches(ranges.select("conv_id", "role", "text", "n"), _numbering, NUMBERED_DDL), "numbered")
    tasks = numbered.groupBy("conv_id", "task").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = tasks.select("conv_id", "task", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    first = F.col("start") + F.col("place")
    return numbered.join(starts, ["conv_id", "task"]).select(
        "conv_id", "role", "text", F.explode(F.sequence(first + 1, first + F.col("n"))).alias("pos")
    )


def taken(conv_id: Column) -> Column:
    """How many turns a conversation takes from its template."""
    return F.crc32(conv_id.cast("string").cast("binary")) % TAKEN


def token(role: Column, text: Column) -> Column:
    """Identity of one turn."""
    return F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def with_templates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on their templates' first turns.

    Gives the turns (``conv_id``, ``pos``, ``token``, ``chars``) and all conversations (``conv_id``, ``n_turns``).
    """
    own = rows.select(
        "conv_id", "pos", token(F.col("role"), F.col("text")).alias("token"), F.length("text").cast("bigint").alias("chars")
    )
    base = F.col("conv_id") - F.col("conv_id") % TEMPLATES
    conversations = own.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    wanted = conversations.select("conv_id", base.alias("base"), taken(F.col("conv_id")).alias("head"))
    # At most TEMPLATES conversations of at most TAKEN - 1 turns each hang on one template.
    lent = own.where((F.col("pos") < TAKEN) & (F.col("conv_id") % TEMPLATES == 0)).withColumnRenamed("conv_id", "base")
    first = lent.join(wanted, "base").where(F.col("pos") <= F.col("head")).select("conv_id", "pos", "token", "chars")
    lengths = lent.groupBy("base").agg(F.max("pos").alias("lent"))
    shift = (
        wanted.join(lengths, "base", "left")
        .select("conv_id", "head", F.least("head", F.coalesce("lent", F.lit(0))).alias("shared"))
        .join(conversations, "conv_id")
        .select(
            "conv_id",
            "head",
            (F.col("shared") - F.col("head")).alias("shift"),
            (F.col("shared") + F.greatest(F.lit(0), F.col("n_own") - F.col("head"))).alias("n_turns"),
        )
    )
    rest = own.join(shift, "conv_id").where(F.col("pos") > F.col("head"))
    rest = rest.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "token", "chars")
    return first.unionByName(rest), shift.select("conv_id", "n_turns")


def blocks(rows: DataFrame, depth: int) -> dict[int, DataFrame]:
    """For each power of two below ``depth``: digests of the full aligned runs of so many turns."""
    level = rows.select("conv_id", (F.col("pos") - 1).alias("block"), F.col("token").alias("digest"))
    levels, size = {}, 1
    while size < depth:
        levels[size] = level = staged(level, f"blocks{size}")
        size *= 2
        halves = level.groupBy("conv_id", F.expr("block div 2").alias("block")).agg(
            F.count("*").alias("n"),
            F.max(F.when(F.col("block") % 2 == 0, F.col("digest"))).alias("left"),
            F.max(F.when(F.col("block") % 2 == 1, F.col("digest"))).alias("right"),
        )
        whole = F.sha2(F.concat("left", "right").cast("binary"), 256)
        level = halves.where(F.col("n") == 2).select("conv_id", "block", whole.alias("digest"))
    return levels


def _power(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def named_prefixes(rows: DataFrame, conversations: DataFrame) -> tuple[DataFrame, int]:
    """(``conv_id``, ``depth``, ``name`` of every prefix, the power of two that all depths lie below)."""
    root, deepest = conversations.agg(F.min("conv_id"), F.max("n_turns")).first()
    size = _power((deepest or 0) + 1)
    digests = blocks(rows, size)
    pieces = conversations.select("conv_id", "n_turns", F.lit(0).cast("bigint").alias("start"), F.lit(root).cast("bigint").alias("tree"))
    names = [pieces.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.col("tree").alias("name"))]
    while size > 1:
        half = size // 2
        cut = F.col("start") + half
        halved = pieces.where(F.col("n_turns") >= cut).withColumn("block", F.expr(f"start div {half}"))
        halved = halved.join(digests[half], ["conv_id", "block"]).drop("block")
        smallest = halved.groupBy("tree", "start", "digest").agg(F.min("conv_id").alias("name"))
        below = halved.join(smallest, ["tree", "start", "digest"]).select("conv_id", "n_turns", cut.alias("start"), F.col("name").alias("tree"))
        below = staged(below, f"cut{half}")
        names.append(below.select("conv_id", F.col("start").alias("depth"), F.col("tree").alias("name")))
        pieces = pieces.unionByName(below)
        size = half
    everything = names[0]
    for part in names[1:]:
        everything = everything.unionByName(part)
    return everything, _power((deepest or 0) + 1)


def grafted(nodes: DataFrame, names: DataFrame, size: int, sums: list[str]) -> DataFrame:
    """``nodes`` (``conv_id``, ``depth`` and the columns ``sums``) with every sum taken over the node's subtree."""
    totals = nodes.select("conv_id", "depth", *sums)
    width = 2
    while width <= size:
        half = width // 2
        piece = F.expr(f"depth div {width}")
        lower = totals.where((F.col("depth") % width) == half).withColumn("piece", piece).drop("depth")
        # The way from a lower tree's root up to the root of its piece lies on one conversation's prefixes.
        upper = names.where((F.col("depth") % width) < half).withColumn("piece", piece)
        gained = (
            upper.join(lower, ["conv_id", "piece"])
            .groupBy(F.col("name").alias("conv_id"), "depth")
            .agg(*[F.sum(c).alias(f"{c}_gained") for c in sums])
        )
        totals = staged(
            totals.join(gained, ["conv_id", "depth"], "left").select(
                "conv_id", "depth", *[(F.col(c) + F.coalesce(f"{c}_gained", F.lit(0))).alias(c) for c in sums]
            ),
            f"grafted{width}",
        )
        width *= 2
    return totals


def _hashing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, run, text) in order; the runs of a node are neighbours."""
    current, digest = None, None
    for batch in batches:
        done = []
        places = zip(batch.column("conv_id").to_pylist(), batch.column("depth").to_pylist(), strict=True)
        for place, ids in zip(places, batch.column("ids").to_pylist(), strict=True):
            if place == current:
                digest.update(b"," + ids.encode())
                continue
            if current is not None:
                done.append((*current, digest.hexdigest()))
            current, digest = place, hashlib.sha256(ids.encode())
        if done:
            yield arrow_rows(ENDS, zip(*done, strict=True))
    if current is not None:
        yield arrow_rows(ENDS, [[current[0]], [current[1]], [digest.hexdigest()]])


def ends(names: DataFrame, conversations: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node in which conversations end."""
    last = names.join(conversations, "conv_id").where(F.col("depth") == F.col("n_turns"))
    runs = last.groupBy("name", "depth", F.floor(F.col("conv_id") / RUN).alias("run")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")
    )
    runs = runs.select(F.col("name").alias("conv_id"), "depth", "run", "ids")
    ordered = runs.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "run")
    return on_batches(ordered.select("conv_id", "depth", "ids"), _hashing, ENDS_DDL)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie over rebuilt conversations."""
    rows, convs = with_templates(staged(turns(conversations), "ordered"))
    return trie_of(staged(rows, "rebuilt"), staged(convs, "lengths"))


def trie_of(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The trie of sequences given as turns (``conv_id``, ``pos`` from 1, ``token``, ``chars``) and their lengths."""
    names, size = named_prefixes(rows, conversations)
    names = staged(names, "names")
    members = names.groupBy("name", "depth").agg(F.count("*").alias("n_convs")).withColumnRenamed("name", "conv_id")
    # A node's path is that of the conversation it is named by, and so are its parent and its last turn.
    parents = names.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent_conv_id"))
    texts = rows.select("conv_id", F.col("pos").alias("depth"), "chars")
    nodes = members.join(parents, ["conv_id", "depth"], "left").join(texts, ["conv_id", "depth"], "left")
    children = nodes.where(F.col("depth") > 0).groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["conv_id", "depth"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).cast("bigint").alias("saved_tokens"),
    )
    nodes = staged(nodes, "nodes")
    totals = grafted(nodes, names, size, ["n_leaves", "saved_tokens"])
    key = ["conv_id", "depth"]
    return (
        nodes.drop("n_leaves", "saved_tokens")
        .join(totals, key)
        .join(ends(names, conversations), key, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    )

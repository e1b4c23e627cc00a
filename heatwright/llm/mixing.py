"""Mixing sources to target weights, by DataFrame operations only.

Every source's words are packed into blocks of BLOCK words: a document's place is the number of words before
it in its source, a two-level running sum over hashed buckets, so a hot source is shared out. Targets are
filled like water: proportional to the weights, none above REPEATS times its source. A source's target is cut
into slots, one block each (the last one shorter, so that the target is met to the word). Output shards draw
their sources: every place of the output draws one of all slots by hash, which is a multinomial draw with
the targets as weights; a shard's draws of a source take that source's next slots, and draws beyond a
source's slots go to those left over elsewhere, index by index. Slots become blocks through a pseudorandom
permutation of the source's block numbers (swap-or-not rounds), one pass over the blocks after the other, and
the documents' pieces are joined by block number.

Everything is a function of the rows: no random state, reruns agree. Defined results: null and empty texts
have size 0 and are never taken; null sources are one source, ordered last; repeated rows are packed one after
the other; null ids are carried along. An empty table, or one without a word, mixes to nothing. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatwright.llm.texts import WORD, only, staged, unused

# Weights of the sources in turn, and the share of all words that is wanted.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2

BLOCK = 512
BUCKET_ROWS = 50_000  # documents numbered in one task, about
LEAST_BUCKETS = 64
SHARD = 4096  # slots per output shard
CHUNK = 2048  # numbers one row expands to at once
TASK = 16_384  # numbers one task makes
MOST_TASKS = 100_000
RANGE = 4096  # shards summed in one task
ROUNDS = 24
SEED = 20_240_607


def numbered(df: DataFrame, count: Column, name: str, total: int, *kept: str) -> DataFrame:
    """One row for each number from 0 below ``count``; ``total`` of them are expected.

    A row expands in two steps, so that it never becomes too many at once, and in as many tasks as the total needs.
    """
    chunks = df.select(
        *kept,
        count.alias("_count"),
        F.explode(F.sequence(F.lit(0), F.floor((count - 1) / CHUNK))).alias("_chunk"),
    )
    low = F.col("_chunk") * CHUNK
    return chunks.repartition(_tasks(total), *kept, "_chunk").select(
        *kept, F.explode(F.sequence(low, F.least(low + CHUNK, F.col("_count")) - 1)).alias(name)
    )


def _tasks(total: int) -> int:
    return max(1, min(-(-total // TASK), MOST_TASKS))


def before_in_order(df: DataFrame, value: str, name: str, place: str, *keys: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same keys with a smaller ``place`` (a whole number).

    Places are taken in ranges of RANGE: sums of the ranges first, then within each range, so no task sees them all. Of
    equal places all count as one, and the sum before them stands in each.
    """
    part = unused(df, "_range")
    ranged = df.withColumn(part, F.floor(F.col(place) / RANGE))
    sums = ranged.groupBy(*keys, part).agg(F.sum(value).alias("_held"))
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, part, F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*keys, part).orderBy(place).rangeBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    same = F.col(f"w.{part}") == F.col(f"s.{part}")
    for key in keys:
        same = same & F.col(f"w.{key}").eqNullSafe(F.col(f"s.{key}"))
    columns = [F.col(f"w.{c}") for c in df.columns if c != name]
    return within.alias("w").join(starts.alias("s"), same).select(*columns, (F.col("s._start") + F.col("w._inner")).alias(name))


def permuted(index: Column, size: Column, key: Column) -> Column:
    """``index`` under a pseudorandom permutation of 0 .. size - 1; ``size`` may be any number."""

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(key, r, F.lit(SEED)), size) - x, size)
        turn = F.xxhash64(key, r, F.greatest(x, partner), F.lit(SEED + 1)).bitwiseAND(F.lit(1))
        return F.when(turn == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, swap)


def sized_documents(docs: DataFrame) -> DataFrame:
    docs = only(docs, "doc_id", "source", "text")
    return docs.select(
        "doc_id",
        "source",
        F.xxhash64("doc_id", "text").alias("mark"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )


def source_targets(sized: DataFrame) -> DataFrame:
    """``source``, ``source_size`` and ``target`` (double), and the slots that make it up."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # The windows here see one row per source.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = F.col("source_size") * REPEATS
    by_fill = Window.orderBy(F.col("fill"), F.col("place"))
    level = (F.col("total") - F.col("capped")) / F.col("open")
    sources = (
        sources.withColumn("place", place)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int")))
        .withColumn("fill", cap / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * SHARE)
        .withColumn("capped", F.coalesce(F.sum(cap).over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", F.when(level <= F.col("fill"), level))
        .withColumn("level", F.first("level", ignorenulls=True).over(by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("target", F.least(cap.cast("double"), F.coalesce("level", F.lit(0.0)) * F.col("weight")))
    )
    words = F.round("target").cast("bigint")
    size = F.greatest("source_size", F.lit(1))
    blocks = F.ceil(F.col("source_size") / BLOCK)
    sources = sources.select(
        "source",
        "place",
        "source_size",
        "target",
        blocks.alias("blocks"),
        F.floor(words / size).alias("passes"),
        (words % size).alias("rest"),
    ).withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / BLOCK))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return sources.withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0)))


def _same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def packed_starts(sized: DataFrame) -> DataFrame:
    """Documents with words, and ``start``: the words before them in their source."""
    buckets = max(LEAST_BUCKETS, sized.count() // BUCKET_ROWS)
    sized = sized.filter("size > 0").withColumn("bucket", F.pmod("mark", F.lit(buckets)))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = (
        Window.partitionBy("source", "bucket").orderBy("mark", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    )
    inner = sized.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return (
        inner.alias("d")
        .join(sums.alias("b"), _same_source("d", "b") & (F.col("d.bucket") == F.col("b.bucket")))
        .select("d.doc_id", "d.source", "d.mark", "d.size", (F.col("b.base") + F.col("d.inner")).alias("start"))
    )


def document_pieces(starts: DataFrame) -> DataFrame:
    """The part of each document in each block: ``block``, ``at`` (its place in the block), ``first_word``, ``words``."""
    end = F.col("start") + F.col("size")
    pieces = starts.select(
        "*",
        F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((end - 1) / BLOCK))).alias("block"),
    )
    low = F.greatest("start", F.col("block") * BLOCK)
    high = F.least(end, (F.col("block") + 1) * BLOCK)
    return pieces.select(
        "*",
        (low - F.col("block") * BLOCK).alias("at"),
        (low - F.col("start")).alias("first_word"),
        (high - low).alias("words"),
    )


def placements(targets: DataFrame) -> DataFrame:
    """Every slot of the mix: ``shard``, ``source``, ``slot``, the ``block`` in it and how many of its
    words are taken (``limit``)."""
    total = targets.agg(F.sum("slots").alias("n")).first()["n"] or 0
    slots = numbered(targets.filter("slots > 0"), F.col("slots"), "slot", total, "source", "first_slot", "slots")
    slots = staged(slots, "slots").withColumn("number", F.col("first_slot") + F.col("slot"))
    # Every place of the output draws a slot; only the slot's source counts.
    drawn = slots.select(
        F.floor(F.col("number") / SHARD).alias("shard"),
        F.pmod(F.xxhash64("number", F.lit(SEED)), F.lit(max(total, 1))).alias("number"),
    ).join(slots.select("number", "source", "slots"), "number")
    counts = drawn.groupBy("shard", "source", "slots").agg(F.count("*").alias("n"))
    counts = staged(before_in_order(staged(counts, "draws"), "n", "first", "shard", "source"), "draws")
    fitting = counts.withColumn("n", F.least(F.col("n"), F.col("slots") - F.col("first"))).filter("n > 0")
    fitting = numbered(fitting, F.col("n"), "k", total, "shard", "source", "first").select(
        "shard", "source", (F.col("first") + F.col("k")).alias("slot")
    )
    # Draws beyond a source's slots, and slots that nobody drew: as many of each, matched in order of shards and sources.
    surplus = counts.withColumn("n", F.col("first") + F.col("n") - F.greatest("first", "slots")).filter("n > 0")
    surplus = surplus.groupBy("shard").agg(F.sum("n").alias("n"))
    surplus = before_in_order(surplus, "n", "first", "shard")
    surplus = numbered(surplus, F.col("n"), "k", total, "shard", "first").select(
        "shard", (F.col("first") + F.col("k")).alias("match")
    )
    got = counts.groupBy("source").agg(F.sum("n").alias("got"))
    short = (
        targets.alias("t")
        .join(got.alias("g"), _same_source("t", "g"), "left")
        .select("t.source", "t.place", F.coalesce("g.got", F.lit(0)).alias("got"), "t.slots")
        .filter("got < slots")
        .withColumn("n", F.col("slots") - F.col("got"))
    )
    short = before_in_order(short, "n", "first", "place")
    short = numbered(short, F.col("n"), "k", total, "source", "got", "first").select(
        "source", (F.col("got") + F.col("k")).alias("slot"), (F.col("first") + F.col("k")).alias("match")
    )
    placed = fitting.unionByName(surplus.join(short, "match").select("shard", "source", "slot"))
    full = F.floor(F.col("t.blocks")) - (F.col("t.source_size") % BLOCK > 0).cast("int")
    turn = F.floor(F.col("p.slot") / F.col("t.blocks"))
    place = F.col("p.slot") % F.col("t.blocks")
    # The short last block, if any, stays last in every pass; the full ones are permuted.
    block = F.when(place < full, permuted(place, full, F.xxhash64("t.source", turn))).otherwise(place)
    limit = F.when(turn < F.col("t.passes"), F.lit(BLOCK)).otherwise(F.least(F.lit(BLOCK), F.col("t.rest") - place * BLOCK))
    return (
        placed.alias("p")
        .join(targets.alias("t"), _same_source("p", "t"))
        .select("p.shard", "p.source", "p.slot", block.alias("block"), limit.cast("bigint").alias("limit"))
    )


def taken_words(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` of each row of ``docs``."""
    sized = staged(sized_documents(docs), "sized")
    targets = staged(source_targets(sized), "targets")
    # What the mix takes of each block: whole, or its first words.
    blocks = placements(targets).groupBy("source", "block").agg(F.collect_list("limit").alias("limits"))
    pieces = document_pieces(packed_starts(sized))
    taken = F.aggregate(
        "k.limits",
        F.lit(0).cast("bigint"),
        lambda done, limit: done + F.greatest(F.lit(0), F.least(F.col("p.words"), limit - F.col("p.at"))),
    )
    used = (
        pieces.alias("p")
        .join(blocks.alias("k"), _same_source("p", "k") & (F.col("p.block") == F.col("k.block")), "left")
        .select("p.doc_id", "p.source", "p.size", "p.start", F.coalesce(taken, F.lit(0)).cast("bigint").alias("taken"))
        .groupBy("source", "start", "doc_id", "size")
        .agg(F.sum("taken").alias("taken"))
        .select("doc_id", "source", "size", "taken")
        .unionByName(
            sized.filter("size = 0").select("doc_id", "source", "size", F.lit(0).cast("bigint").alias("taken"))
        )
    )
    return (
        used.alias("u")
        .join(targets.alias("t"), _same_source("u", "t"))
        .select("u.doc_id", "u.size", "t.source_size", "t.target", "u.taken")
    )


def mixed_blocks(docs: DataFrame) -> DataFrame:
    """The mix itself: one row for each document piece in each slot, with its text.

    ``shard``, ``source``, ``slot``, ``block``, ``at`` (place in the block), ``doc_id``, ``first_word``,
    ``words`` and ``text`` (the words, joined by blanks).
    """
    sized = staged(sized_documents(docs), "sized")
    targets = staged(source_targets(sized), "targets")
    pieces = document_pieces(packed_starts(sized))
    cut = F.least(F.col("p.words"), F.col("k.limit") - F.col("p.at"))
    used = (
        pieces.alias("p")
        .join(placements(targets).alias("k"), _same_source("p", "k") & (F.col("p.block") == F.col("k.block")))
        .select(
            "k.shard", "p.source", "k.slot", "p.block", "p.at", "p.doc_id", "p.mark", "p.start", "p.first_word", cut.alias("words")
        )
        .filter("words > 0")
    )
    # Each row's text travels once, with all places it goes to; rows that repeat id and text have each their own start.
    places = used.groupBy("doc_id", "mark", "source", "start").agg(
        F.collect_list(F.struct("shard", "source", "slot", "block", "at", "first_word", "words")).alias("places")
    )
    texts = only(docs, "doc_id", "text").withColumn("mark", F.xxhash64("doc_id", "text")).dropDuplicates(["doc_id", "mark"])
    joined = places.alias("p").join(
        texts.alias("t"), F.col("p.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("p.mark") == F.col("t.mark"))
    )
    cut_texts = F.transform(
        "places",
        lambda s: s.withField(
            "text",
            F.array_join(F.slice("all_words", (s["first_word"] + 1).cast("int"), s["words"].cast("int")), " "),
        ),
    )
    rows = joined.select("p.doc_id", "p.places", F.regexp_extract_all("t.text", F.lit(f"({WORD})")).alias("all_words"))
    return rows.select("doc_id", F.explode(cut_texts).alias("s")).select(
        "s.shard", "s.source", "s.slot", "s.block", "s.at", "doc_id", "s.first_word", "s.words", "s.text"
    )

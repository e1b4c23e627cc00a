"""Audit of how filters interact: what each removes in every order, with exact duplicates found by radix tries.

Five filters judge whole texts. A to D look at one text (``masks``). E fails a document whose text also stands
under a smaller id anywhere in the table. For E the texts are dealt out by ranges of their prefix: a prefix whose
texts are too many bytes for one trie is lengthened, level by level, until it is light or its texts end. Each
range of texts goes into a compressed trie (``RadixTrie``) whose terminals hold the smallest id; walking it gives
that id for every different text. Before the shuffle every task does the same for its own rows, so a text copied
millions of times leaves each task once.

The flags of a document then are five bits. Documents are reduced to counts by (part, bits, good, toxic), those to
what each filter removes after each set of earlier ones (80 sums a part), and these are looked up for the 120 orders.

Defined results: a null text is empty. A null source is the empty part. A null ``doc_id`` is never a copy and never
makes one, nor has it labels; its other filters count. Rows that repeat an id and its text are no copies of each
other. A document is good or toxic where any label row of its id says so; other values and nulls say nothing. An
empty table has no parts. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, as_bytes, code_points, on_batches, only, staged

# The filters' names and limits.
FILTERS = "ABCDE"
FEWEST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_CAPITALS = 2  # percent of the code points
SYMBOLS = b"#$%&*|"
COPY = 16  # bit of filter E

# Prefixes of FIRST code points are lengthened GROWTH times over while their texts exceed a trie's share: at
# least TRIE_BYTES, at most 1 / RANGES of all, so never more than RANGES prefixes of a level are kept.
FIRST = 8
GROWTH = 8
TRIE_BYTES = 8 << 20
RANGES = 100_000
# A task hands its texts on whenever it holds so many bytes.
HELD_BYTES = 32 << 20
HEAD = 64

_CAPITALS = bytes(range(65, 91))

MASKED = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("mark", pa.int64())])
MASKED_DDL = "doc_id bigint, part string, mask int, mark bigint"
ROUTED = pa.schema([("head", pa.binary()), ("route", pa.int64()), ("text", pa.binary()), ("least", pa.int64())])
ROUTED_DDL = "head binary, route bigint, text binary, least bigint"
FOUND = pa.schema([("least", pa.int64()), ("mark", pa.int64())])
FOUND_DDL = "least bigint, mark bigint"


class RadixTrie:
    """Compressed trie over byte strings: an edge holds all bytes up to the next fork, a terminal its smallest id."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]  # edge, children by first byte, smallest id
        self.held = 0

    def insert(self, text: bytes, doc_id: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                node[1][text[at]] = [text[at:], {}, doc_id]
                self.held += len(text) - at
                return
            edge = child[0]
            if not text.startswith(edge, at):
                same = _shared(edge, text, at)
                fork = [edge[:same], {edge[same]: child}, None]
                child[0] = edge[same:]
                node[1][text[at]] = child = fork
            node, at = child, at + len(child[0])
        node[2] = doc_id if node[2] is None else min(node[2], doc_id)

    def terminals(self) -> Iterator[tuple[bytes, int]]:
        """(text, smallest id) of every different text."""
        waiting = [(self.root, b"")]
        while waiting:
            node, before = waiting.pop()
            text = before + node[0]
            if node[2] is not None:
                yield text, node[2]
            waiting.extend((child, text) for child in node[1].values())


def _shared(edge: bytes, text: bytes, at: int) -> int:
    """Length of the longest prefix of ``edge`` that stands in ``text`` from ``at``; less than all of it."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(edge[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def mask(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    bits = int(len(words) < FEWEST_WORDS)
    bits |= 2 * (100 * len(set(words)) < LEAST_DISTINCT * len(words))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    bits |= 4 * (100 * capitals > MOST_CAPITALS * code_points(text))
    return bits | 8 * (len(text.translate(None, SYMBOLS)) < len(text))


def _masking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks = [mask(text) for text in as_bytes(batch)]
        yield arrow_rows(MASKED, [batch.column("doc_id"), batch.column("part"), masks, batch.column("mark")])


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def masks(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` (filters A to D) and ``mark`` (hash of the text) of each row."""
    rows = only(docs, "doc_id", "text", "source").select(
        F.col("doc_id").cast("bigint"), "text", F.coalesce("source", F.lit("")).alias("part"), _mark(F.col("text")).alias("mark")
    )
    return on_batches(rows, _masking, MASKED_DDL)


def heavy_prefixes(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> tuple[list[tuple[int, frozenset[int]]], int]:
    """([(length, hashes of the prefixes of that length to be lengthened)], bytes of all texts).

    Each level reads the texts whose prefix was heavy one level before. At most RANGES hashes a level.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    open_texts = docs.select(text.alias("text"), F.octet_length(text).alias("bytes"))
    total = open_texts.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    most = max(trie_bytes, total // RANGES)
    levels, length = [], FIRST
    while True:
        route = F.xxhash64(F.substring("text", 1, length))
        sums = open_texts.groupBy(route.alias("route")).agg(
            F.sum("bytes").alias("bytes"), F.max(F.length("text")).alias("longest")
        )
        heavy = [row[0] for row in sums.where((F.col("bytes") > most) & (F.col("longest") > length)).select("route").collect()]
        if not heavy:
            return levels, total
        levels.append((length, frozenset(heavy)))
        known = F.broadcast(docs.sparkSession.createDataFrame([(h,) for h in heavy], "route bigint"))
        open_texts = open_texts.withColumn("route", route).join(known, "route", "left_semi").select("text", "bytes")
        length *= GROWTH


def _routing(shared):
    """Tasks' own tries: each different text once, with its range and its smallest id there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        levels = shared.value

        def route(text: bytes) -> tuple[bytes, int]:
            whole, length = text.decode("utf-8", "replace"), FIRST
            for length, heavy in levels:
                prefix = whole[:length].encode()
                hashed = _signed(xxhash.xxh64_intdigest(prefix, 42))
                if hashed not in heavy:
                    return prefix[:HEAD], hashed
            prefix = whole[: length * GROWTH if levels else FIRST].encode()
            return prefix[:HEAD], _signed(xxhash.xxh64_intdigest(prefix, 42))

        def handed_on(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for text, least in trie.terminals():
                rows.append((*route(text), text, least))
                size += len(text)
                if size > 1 << 20:
                    yield arrow_rows(ROUTED, zip(*rows, strict=True))
                    rows, size = [], 0
            if rows:
                yield arrow_rows(ROUTED, zip(*rows, strict=True))

        trie = RadixTrie()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch), strict=True):
                trie.insert(text, doc_id)
                if trie.held > HELD_BYTES:
                    yield from handed_on(trie)
                    trie = RadixTrie()
        yield from handed_on(trie)

    return run


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _walking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One trie for each range; a range's rows are neighbours."""
    import xxhash

    def found(trie: RadixTrie) -> Iterator[pa.RecordBatch]:
        rows = [(least, _signed(xxhash.xxh64_intdigest(text, 42))) for text, least in trie.terminals()]
        if rows:
            yield arrow_rows(FOUND, zip(*rows, strict=True))

    trie, current = RadixTrie(), None
    for batch in batches:
        columns = (batch.column("head").to_pylist(), batch.column("route").to_pylist())
        ranges = zip(*columns, strict=True)
        for place, text, least in zip(ranges, as_bytes(batch), batch.column("least").to_pylist(), strict=True):
            if place != current:
                yield from found(trie)
                trie, current = RadixTrie(), place
            trie.insert(text, least)
    yield from found(trie)


def first_of_each_text(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``least`` (the smallest id) and ``mark`` (hash of the text) of each different text; null ids are not read."""
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text").where(F.col("doc_id").isNotNull())
    levels, total = heavy_prefixes(rows, trie_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    tasks = max(1, min(math.ceil(total / (4 * trie_bytes)), RANGES))
    # Sampling the bounds of the ranges must not run the tasks' tries a second time.
    routed = staged(on_batches(rows, _routing(shared), ROUTED_DDL), "routed")
    ranges = routed.repartitionByRange(tasks, "head", "route").sortWithinPartitions("head", "route")
    return on_batches(ranges, _walking, FOUND_DDL)


def flagged(docs: DataFrame, labels: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of all five filters, ``good`` and ``toxic`` (0 or 1) of each row."""
    known = (
        only(labels, "doc_id", "quality", "toxic")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(_any_one("quality").alias("good"), _any_one("toxic").alias("toxic"))
        .where(F.col("doc_id").isNotNull())
    )
    first = first_of_each_text(docs, trie_bytes).select(F.col("least").alias("doc_id"), "mark", F.lit(True).alias("first"))
    rows = masks(docs)
    # Rows without an id go past the joins, or they would all meet in one task.
    matched = rows.where(F.col("doc_id").isNotNull()).join(known, "doc_id", "left").join(first, ["doc_id", "mark"], "left")
    rows = matched.unionByName(rows.where(F.col("doc_id").isNull()), allowMissingColumns=True)
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.select(
        "doc_id",
        "part",
        (F.col("mask") + F.when(copy, COPY).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def _any_one(name: str) -> Column:
    return F.coalesce(F.max(F.when(F.col(name) == 1, 1).otherwise(0)), F.lit(0))


def _orders() -> list[tuple[str, int, str, int, int]]:
    """(order, step, filter, its bit, bits of the filters before it) of all steps of all orders."""
    rows = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            rows.append(("".join(order), step, name, bit, before))
            before |= bit
    return rows


def audit(docs: DataFrame, labels: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """A row for each part, order of the filters and step."""
    spark = docs.sparkSession
    counts = (
        flagged(docs, labels, trie_bytes).groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    )
    # 5 filters x 16 sets of earlier ones, each with the number of orders that have them so; 600 steps.
    cases = [
        F.struct(
            F.lit(1 << i).alias("bit"),
            F.lit(before).alias("before"),
            F.lit(math.factorial(before.bit_count()) * math.factorial(4 - before.bit_count())).cast("bigint").alias("orders"),
        )
        for i in range(5)
        for before in range(32)
        if not before >> i & 1
    ]
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    stays = F.col("mask").bitwiseAND(F.col("before")) == 0

    def total(where: Column, times: Column | int = 1) -> Column:
        return F.sum(F.when(where, F.col("n") * times).otherwise(0))

    sums = (
        counts.select("*", F.inline(F.array(*cases)))
        .groupBy("part", "bit", "before", "orders")
        .agg(
            total(stays & ~fails).alias("kept"),
            total(stays & fails).alias("removed"),
            total(~stays & fails).alias("redundant"),
            total(F.col("mask") == F.col("bit")).alias("unique_fails"),
            total(stays & fails, F.col("good")).alias("good_lost"),
            total(stays & fails, F.col("toxic")).alias("toxic_lost"),
        )
    )
    shares = F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "bit"))
    sums = sums.withColumn("shapley", shares)
    steps = spark.createDataFrame(_orders(), "filter_order string, step int, filter string, bit int, before int")
    return sums.join(F.broadcast(steps), ["bit", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )

"""Near duplicates by an LSH forest over minhash signatures, confirmed on the full shingle sets.

A document is the set of its distinct word shingles (lower-cased A-Z, five words; a shorter text is one
shingle of all its words). Documents with equal sets form a class, and only one representative of each class
is searched. Each tree of the forest is one sorted order of the signature's values; documents that agree on
the first values of an order stand next to each other in it. A region is such a run with a common prefix.
Where a region has more members than one task should compare, the prefix is lengthened until it splits, so
depth follows the density of the data. The members of a region are dealt to blocks, differently in each tree, and
each pair of blocks is compared by sketch as a group of its own, so no task has a whole dense region. Only pairs of
documents not yet in one component are handed on: first each document's nearest ones within its block, then, in
regions that the links found so far have not merged, the nearest of all blocks, and last all that is left. A longer prefix may part documents that
belong together, so the members of lengthened regions are joined once more, by an exact prefix filter over
their rarest shingles, between components only. Components come from alternating star contractions, all in
Spark.

Defined results: null or empty texts (and texts without a word) have an empty set, are linked with nothing
and keep their own id as component. A row without ``doc_id`` takes no part in linking: component null, kept.
Rows that share a ``doc_id`` count as one document with several texts. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, as_bytes, mixed, on_batches, only, pieces, staged, unused

SHINGLE = 5
# Links need 100 * intersection >= threshold * union: of the contract's query, and of the pipeline's stage.
THRESHOLD = 85
STAGE_THRESHOLD = 80

# Values of the signature. Each tree reads them from its own starting point on, round the circle.
VALUES = 64
TREES = 8
# Bytes of the sketch: one more hash function each, for documents that have neighbours in the forest.
SKETCH = 512
# Prefix lengths (values) tried from the shallowest on, and the members up to which a region is compared.
DEPTHS = (2, 4, 6, 8, 12, 16, 32, 64)
REGION = 2048
# Members of a block: two blocks of a region are compared at a time.
BLOCK = 256
# Standard errors below the threshold at which a pair's sketch agreement is not worth verifying.
SKETCH_ERRORS = 4.1
# Counters of the shingles in lengthened regions (a power of two): they rank shingles, rarest first.
COUNTER_BITS = 20
# Buckets of 32,768 bits in the filter of the documents that need their shingle sets.
FILTER_BUCKETS = 512
# Partners a document names per group in each round; None names all that are left.
ROUNDS = (3, 3, None)
# Pairs named for two components in one group, before the last round.
NAMED = 8

_FACTORS = (mixed(np.arange(1, VALUES + SKETCH + 1)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (mixed(np.arange(1001, 1001 + VALUES + SKETCH)) >> np.uint64(32)).astype(np.uint32)
_PLACES = mixed(np.arange(5001, 5001 + SHINGLE)) | np.uint64(1)

SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("set_key", pa.binary()),
        ("tree_values", pa.binary()),
    ]
)
SIGNED_DDL = "doc_id bigint, n_shingles bigint, set_key binary, tree_values binary"


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < size:
        return mixed(np.array([np.sum(hashes * _PLACES[:n]) + np.uint64(n)], np.uint64))
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total += hashes[k : n - size + 1 + k] * _PLACES[k]
    return np.unique(mixed(total))


def signature(shingles: np.ndarray, functions: slice) -> np.ndarray:
    """The least value of each of some hash functions over the set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    factors, shifts = _FACTORS[functions, None], _SHIFTS[functions, None]
    least = np.full(len(factors), np.uint32(0xFFFFFFFF))
    for start in range(0, len(low), 512):
        part = factors * low[None, start : start + 512]
        part += shifts
        np.minimum(least, part.min(axis=1), out=least)
    return least


def _signed_row(text: bytes) -> tuple:
    shingles = shingle_hashes(text)
    if not len(shingles):
        return 0, None, None
    return (
        len(shingles),
        hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(),
        signature(shingles, slice(VALUES)).astype(">u4").tobytes(),
    )


def sketch(shingles: np.ndarray) -> bytes:
    """The low byte of each further hash function's least value."""
    least = signature(shingles, slice(VALUES, None))
    return (least & np.uint32(0xFF)).astype(np.uint8).tobytes()


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in pieces(batch):
                found = [_signed_row(text) for text in as_bytes(part)]
                yield arrow_rows(SIGNED, [part.column("doc_id"), *zip(*found, strict=True)])


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary()), ("sketch", pa.binary())])
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in pieces(batch, 200):
                sets = [shingle_hashes(text) for text in as_bytes(part)]
                yield arrow_rows(
                    schema, [part.column("doc_id"), [s.tobytes() for s in sets], [sketch(s) for s in sets]]
                )


# ---------------------------------------------------------------- forest


def sketch_least(threshold: int) -> float:
    share = threshold / 100
    return share - SKETCH_ERRORS * (share * (1 - share) / SKETCH) ** 0.5


def forest_regions(reps: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``region`` (hash of tree and prefix), ``tree``, ``node`` and ``blocks`` (of the region) of every run with two or
    more members, and the ``node``s of runs that were too long at the first depth (None without any).

    Each tree's rows are counted per prefix; runs above REGION go on to the next depth. A run that still
    is too long at the last depth (thousands of different sets agreeing on all values) is dealt into salted
    parts, differently in each tree, so that the trees together join the parts.
    """
    # The circle of values, doubled, so that each tree's order is one slice.
    ring = F.concat("tree_values", "tree_values")
    step = 4 * VALUES // TREES
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rest = reps.select("node", "tree_values", trees)
    done, dense = [], None
    blocks = F.ceil(F.col("members") / BLOCK).alias("blocks")
    for depth in DEPTHS:
        prefix = F.substring(ring, F.col("tree") * step + 1, F.lit(4 * depth))
        rest = rest.select("node", "tree", F.xxhash64("tree", F.lit(depth), prefix).alias("region"))
        sizes = rest.groupBy("region").agg(F.count("*").alias("members")).filter("members > 1")
        rest = staged(rest.join(sizes, "region"), "forest")
        last = depth == DEPTHS[-1]
        done.append(rest.filter(F.col("members") <= REGION).select("region", "tree", "node", blocks))
        rest = rest.filter(F.col("members") > REGION)
        if last:
            part = F.pmod(F.xxhash64("node", "tree"), F.ceil(2 * F.col("members") / REGION))
            salted = F.xxhash64("region", part).alias("region")
            done.append(rest.select(salted, "tree", "node", F.lit(-(-REGION // BLOCK)).cast("bigint").alias("blocks")))
        rest = rest.select("node", "tree")
        if last or rest.isEmpty():
            break
        if dense is None:
            dense = rest.select("node").distinct()
        rest = rest.join(reps.select("node", "tree_values"), "node")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return staged(out, "regions"), dense


def _agreement(block: np.ndarray, others: np.ndarray) -> np.ndarray:
    out = np.empty((len(block), len(others)), np.float32)
    for i, row in enumerate(block):
        out[i] = np.count_nonzero(others == row, axis=1)
    # Bytes of different values agree once in 256.
    return (out / SKETCH - 1 / 256) / (1 - 1 / 256)


def _group_pairs(nodes, comps, sketches, earlier, tried, sides, most, least) -> Iterator[tuple[int, int]]:
    """Pairs of one group worth verifying: different components, not tried, sketches alike.

    ``earlier`` has the members' regions in the trees before this one: a pair is named in the first tree
    where it shares a region, and only there. ``sides`` are the members' blocks if two blocks are compared with each
    other, else None.
    """
    n = len(nodes)
    place = {int(node): k for k, node in enumerate(nodes)}
    named: list[tuple[float, int, int]] = []
    for k in range(n):
        around = slice(0, k if most is None else n)
        other = comps[around] != comps[k]
        if sides is not None:
            other &= sides[around] != sides[k]
        other &= ~((earlier[around] == earlier[k]) & (earlier[k] != 0)).any(axis=1)
        if not other.any():
            continue
        alike = _agreement(sketches[k : k + 1], sketches[around])[0]
        alike[~other] = 0
        for old in tried[k] or ():
            at = place.get(old, -1)
            if 0 <= at < len(alike):
                alike[at] = 0
        found = np.flatnonzero(alike >= least)
        if most is None:
            for j in found:
                a, b = int(nodes[k]), int(nodes[j])
                yield (a, b) if a < b else (b, a)
            continue
        if len(found) > most:
            found = found[np.lexsort((nodes[around][found], -alike[found]))[:most]]
        named += [(-float(alike[j]), *sorted((k, int(j)), key=nodes.__getitem__)) for j in found]
    # Two components need one link, not one for each of their members.
    times: Counter[tuple[int, int]] = Counter()
    for _, i, j in sorted(set(named), key=lambda x: (x[0], nodes[x[1]], nodes[x[2]])):
        both = (min(comps[i], comps[j]), max(comps[i], comps[j]))
        times[both] += 1
        if times[both] <= NAMED:
            yield int(nodes[i]), int(nodes[j])


def _pair_batches(most: int | None, least: float, first: bool):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            """Rows of one group after another; the rows come sorted by it."""
            held = None
            for batch in batches:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
                numbers = held.column("group").to_numpy()
                cuts = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
                begin = 0
                for cut in cuts:
                    yield held.slice(begin, int(cut) - begin)
                    begin = int(cut)
                held = held.slice(begin)
            if held is not None and held.num_rows:
                yield held

        out: set[tuple[int, int]] = set()
        for group in groups():
            if group.num_rows < 2:
                continue
            comps = group.column("comp").to_numpy()
            if (comps == comps[0]).all():
                continue
            sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8)
            tree = group.column("tree")[0].as_py()
            homes = np.array(group.column("homes").to_pylist(), np.int64)
            # Blocks by themselves: a pair may be in two blocks of an earlier tree's region, and each tree names one.
            apart = first and group.column("blocks")[0].as_py() > 1
            across = group.column("across")[0].as_py()
            out.update(
                _group_pairs(
                    group.column("node").to_numpy(),
                    comps,
                    sketches.reshape(-1, SKETCH),
                    homes[:, : 0 if apart else tree],
                    group.column("tried").to_pylist(),
                    group.column("block").to_numpy() if across else None,
                    1 if apart else most,
                    least,
                )
            )
            if len(out) > 50_000:
                yield arrow_rows(schema, zip(*out, strict=True))
                out.clear()
        if out:
            yield arrow_rows(schema, zip(*out, strict=True))

    return run


def block_groups(regions: DataFrame, first: bool) -> DataFrame:
    """``group`` and ``across`` for the members of each region: its blocks one by one, or every two of them.

    ``across``: the group holds two blocks, to be compared with each other only.
    """
    block = F.pmod(F.xxhash64("node", "region"), F.col("blocks"))
    dealt = regions.withColumn("block", block)
    others = F.array("block") if first else F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    dealt = dealt.withColumn("other", F.explode(others))
    group = F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other"))
    return dealt.withColumn("group", group).withColumn("across", F.col("block") != F.col("other")).drop("other")


def _verify_batches(threshold: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                linked.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield arrow_rows(schema, [batch.column("a"), batch.column("b"), linked])

    return run


def verified_pairs(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """``a``, ``b`` and whether the two are ``linked``, by their whole sets."""
    with_sets = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b"
    )
    return staged(
        on_batches(
            with_sets.select("a", "b", "set_a", "set_b"), _verify_batches(threshold), "a bigint, b bigint, linked boolean"
        ),
        "verified",
    )


# ---------------------------------------------------------------- exact join of dense parts


def _counters(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    for batch in batches:
        for part in batch.column("shingles").to_pylist():
            counts += np.bincount(_counters(np.frombuffer(part, np.uint64)), minlength=len(counts))
    used = np.flatnonzero(counts)
    schema = pa.schema([("counter", pa.int64()), ("n", pa.int64())])
    for start in range(0, len(used), 100_000):
        part = used[start : start + 100_000]
        yield arrow_rows(schema, [part, counts[part]])


def _prefix_batches(shared, threshold: int):
    schema = pa.schema([(name, pa.int64()) for name in ("token", "node", "comp", "size")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for part in pieces(batch, 50):
                tokens = []
                sizes = []
                for data in part.column("shingles").to_pylist():
                    own = np.frombuffer(data, np.uint64)
                    # Linked sets share this share of the larger one, so one of the rest and one more.
                    keep = len(own) + threshold * len(own) // -100 + 1
                    tokens.append(own[np.lexsort((own, counts[_counters(own)]))[:keep]].view(np.int64))
                    sizes.append(len(own))
                times = [len(t) for t in tokens]
                yield arrow_rows(
                    schema,
                    [
                        np.concatenate(tokens),
                        *[np.repeat(part.column(c).to_numpy(), times) for c in ("node", "comp")],
                        np.repeat(np.array(sizes, np.int64), times),
                    ],
                )

    return run


def prefix_pairs(sets: DataFrame, threshold: int) -> DataFrame:
    """Every pair ``a`` < ``b`` of different components of ``sets`` (node, comp, shingles) that may be linked.

    Any order of the shingles gives an exact filter; counters of a fixed number put the rare ones first.
    A shingle pairs the members outside its commonest component with all members of other components.
    """
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    counted = on_batches(sets.select("shingles"), _count_batches, "counter bigint, n bigint")
    found = counted.groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    counts[found.column("counter").to_numpy()] = found.column("n").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(counts)
    posts = on_batches(
        sets.select("node", "comp", "shingles"),
        _prefix_batches(shared, threshold),
        "token bigint, node bigint, comp bigint, size bigint",
    )
    posts = staged(posts, "prefixes")
    by_comp = posts.groupBy("token", "comp").agg(F.count("*").alias("n"))
    tokens = by_comp.groupBy("token").agg(F.max_by("comp", "n").alias("main"), F.count("*").alias("comps"))
    posts = staged(posts.join(tokens.filter("comps > 1").drop("comps"), "token"), "prefixes")
    small, large = F.least("x.size", "y.size"), F.greatest("x.size", "y.size")
    return (
        posts.filter("comp <> main")
        .alias("x")
        .join(posts.alias("y"), F.col("x.token") == F.col("y.token"))
        .filter("x.comp <> y.comp and (y.comp = y.main or x.node < y.node)")
        .filter(100 * small >= threshold * large)
        .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        .distinct()
    )


# ---------------------------------------------------------------- components


def star_components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp`` (the least node reachable) for every node of ``links`` (a, b).

    Alternating star contractions: every node points its larger neighbours, then its smaller ones, at the
    least node it knows, until nothing changes. Work per round is linear in the links, and the rounds
    grow with the logarithm of the longest path.
    """
    edges = staged(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(),
        "edges",
    )
    while True:
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ends.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.filter("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
        new = staged(small.filter("u <> v").distinct(), "small")
        changed = new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty()
        edges = new
        if changed:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    )


def may_hold(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``docs`` without most rows whose id is not among ``nodes``: a bitmap of fixed size, one bit per hash.

    The bitmap has FILTER_BUCKETS rows of 4 KiB however many nodes there are; bits hit by chance only let
    further rows through. No text is shuffled for it.
    """
    flag = unused(docs, "_held")
    return with_bitmap(docs, nodes, flag).filter(F.col(flag)).drop(flag)


def with_bitmap(docs: DataFrame, nodes: DataFrame, flag: str) -> DataFrame:
    """``docs`` with ``flag``: whether the bitmap of ``nodes`` holds the row's id."""
    bits = F.lit(FILTER_BUCKETS * 32_768)

    def bit(column: str):
        return F.pmod(F.xxhash64(column), bits)

    bucket, bitmap = unused(docs, "_bucket"), unused(docs, "_bitmap")
    bitmaps = nodes.groupBy(F.bitmap_bucket_number(bit("node")).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit("node"))).alias(bitmap)
    )
    place = F.bitmap_bit_position(bit("doc_id"))
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return (
        docs.withColumn(bucket, F.bitmap_bucket_number(bit("doc_id")))
        .join(F.broadcast(bitmaps), bucket, "left")
        .withColumn(flag, held)
        .drop(bucket, bitmap)
    )


def find_links(docs: DataFrame, reps: DataFrame, threshold: int) -> DataFrame | None:
    """``node``, ``comp`` of all representatives that are linked with another one; None if none is."""
    regions, dense = forest_regions(reps)
    # Each node's regions by tree, 0 where it stands alone.
    homes = regions.groupBy("node").agg(
        F.array(*[F.coalesce(F.max(F.when(F.col("tree") == t, F.col("region"))), F.lit(0)) for t in range(TREES)]).alias("homes")
    )
    homes = staged(homes, "homes")
    # The few sets that pass the bitmap by chance meet no pair below.
    sets = may_hold(docs, homes.select("node"))
    sets = staged(on_batches(sets, _shingle_batches, "node bigint, shingles binary, sketch binary"), "sets")
    known = homes.join(sets.select("node", "sketch"), "node")
    tested: DataFrame | None = None
    comps: DataFrame | None = None
    for number, most in enumerate(ROUNDS):
        members, about = regions.withColumn("comp", F.col("node")), known
        if comps is not None:
            members = regions.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            # Regions of one component have nothing left to find. Those that the bitmap lets through are skipped below.
            mixed_regions = members.groupBy("region").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
            mixed_regions = mixed_regions.filter("low < high").select(F.col("region").alias("node"))
            members = may_hold(members.withColumnRenamed("region", "doc_id"), mixed_regions)
            members = members.withColumnRenamed("doc_id", "region")
        if tested is not None:
            refused = tested.filter("not linked")
            refused = refused.select(F.col("a").alias("node"), "b").unionByName(
                refused.select(F.col("b").alias("node"), F.col("a").alias("b"))
            )
            about = about.join(refused.groupBy("node").agg(F.collect_list("b").alias("tried")), "node", "left")
        else:
            about = about.withColumn("tried", F.lit(None).cast("array<bigint>"))
        members = block_groups(members.join(about, "node"), number == 0).select(
            "group", "across", "block", "blocks", "tree", "node", "homes", "comp", "sketch", "tried"
        )
        sorted_rows = members.repartition("group").sortWithinPartitions("group", "node")
        pair_batches = _pair_batches(most, sketch_least(threshold), number == 0)
        named = on_batches(sorted_rows, pair_batches, "a bigint, b bigint")
        verified = verified_pairs(staged(named.distinct(), "pairs"), sets, threshold)
        if verified.isEmpty():
            # Nothing within the blocks does not mean nothing between them.
            if number == 0 and not regions.filter("blocks > 1").isEmpty():
                continue
            break
        tested = verified if tested is None else tested.unionByName(verified)
        links = tested.filter("linked")
        if not links.isEmpty():
            comps = staged(star_components(links), "comps")
    if dense is None:
        return comps
    # What lengthened regions may have parted: the pairs of their members that still are in different components.
    left = sets.join(dense, "node").select("node", "shingles")
    left = left.withColumn("comp", F.col("node")) if comps is None else (
        left.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    )
    pairs = prefix_pairs(staged(left, "dense"), threshold)
    if tested is not None:
        pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    verified = verified_pairs(staged(pairs, "pairs"), sets, threshold)
    more = verified.filter("linked")
    if more.isEmpty():
        return comps
    links = more if tested is None else tested.filter("linked").unionByName(more)
    return staged(star_components(links), "comps")


def same_id_links(members: DataFrame) -> DataFrame:
    """``a``, ``b``: the classes of each ``doc_id`` with texts in several, each with the least of them."""
    nodes = members.select("doc_id", "node")
    least = nodes.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b < last")
    return nodes.join(least, "doc_id").filter("node > b").select(F.col("node").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row per row of ``docs``."""
    docs = only(docs, "doc_id", "text")
    signed = staged(on_batches(docs, _sign_batches, SIGNED_DDL), "signed")
    classes = (
        signed.filter("set_key is not null and doc_id is not null")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("node"))
    )
    own = signed.filter("set_key is not null and doc_id is not null")
    classes = staged(classes, "classes")
    reps = own.join(classes, "set_key").filter("doc_id = node").select("node", "set_key", "tree_values")
    reps = staged(reps.dropDuplicates(["set_key"]), "reps")
    members = own.select("doc_id", "n_shingles", "set_key").join(classes, "set_key").drop("set_key")
    comps = find_links(docs, reps, threshold)
    same = same_id_links(members)
    if not same.isEmpty():
        if comps is not None:
            same = same.unionByName(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")))
        comps = staged(star_components(same), "comps")
    if comps is not None:
        members = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    else:
        members = members.withColumn("comp", F.col("node"))
    alone = signed.filter("set_key is null or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("comp")
    )
    return (
        members.select("doc_id", "n_shingles", "comp")
        .unionByName(alone)
        .select(
            "doc_id",
            "n_shingles",
            F.col("comp").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.col("comp"), F.lit(True)).alias("kept"),
        )
    )


# Room for the numbers that rows get whose id has several texts.
ROW_NUMBERS = 1 << 54


def with_row_keys(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``key``: a number for each different pair of id and text, the id itself where it has one text.

    Only rows whose id has several texts are joined; the others pass a bitmap of such ids without a shuffle, but for
    a few that it lets through by chance.
    """
    marks = (F.xxhash64("text"), F.xxhash64("text", F.lit("again")))
    rows = only(docs, "doc_id", "text").filter("doc_id is not null").select("doc_id", F.struct(*marks).alias("mark"))
    several = rows.groupBy("doc_id").agg(F.min("mark").alias("low"), F.max("mark").alias("high")).filter("low < high")
    several = staged(several.select(F.col("doc_id").alias("node")), "several")
    if several.isEmpty():
        return docs.withColumn(key, F.col("doc_id"))
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if high <= 2**63 - 1 - ROW_NUMBERS:
        first = high + 1
    elif low >= -(2**63) + ROW_NUMBERS:
        first = low - ROW_NUMBERS
    else:  # ids at both ends of what a number holds: every row gets a new one
        first, several = 0, rows.select(F.col("doc_id").alias("node")).distinct()
    pairs = rows.join(several, F.col("doc_id") == F.col("node"), "left_semi").distinct()
    numbers = pairs.select("doc_id", "mark", (F.lit(first) + F.monotonically_increasing_id()).alias("_number"))
    numbers = staged(numbers, "numbers")
    bit, mine = unused(docs, "_may"), unused(docs, "_number")
    known = docs.filter("doc_id is not null")
    marked = with_bitmap(known, several, bit)
    joined = (
        marked.filter(F.col(bit))
        .alias("d")
        .join(
            numbers.alias("n"),
            (F.col("d.doc_id") == F.col("n.doc_id")) & (F.struct(*[F.xxhash64("d.text"), F.xxhash64("d.text", F.lit("again"))]) == F.col("n.mark")),
            "left",
        )
        .select("d.*", F.col("n._number").alias(mine))
    )
    plain = marked.filter(~F.col(bit)).withColumn(mine, F.lit(None).cast("bigint"))
    both = joined.unionByName(plain).withColumn(key, F.coalesce(F.col(mine), F.col("doc_id"))).drop(mine, bit)
    return both.unionByName(docs.filter("doc_id is null").withColumn(key, F.lit(None).cast("bigint")))


def keep_one_of_each(docs: DataFrame, threshold: int = STAGE_THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component of texts, all columns as they are.

    Rows are told apart by id and text, so an id with several unrelated texts keeps them all. Of rows that repeat both
    one stays; rows without an id stay.
    """
    key, mine, copy = unused(docs, "_row"), unused(docs, "_gone"), unused(docs, "_copy")
    rows = with_row_keys(docs, key)
    texts = rows.select(F.col(key).alias("doc_id"), "text")
    gone = near_duplicates(texts, threshold).filter("not kept").select(F.col("doc_id").alias(mine)).distinct()
    known = rows.filter(F.col(key).isNotNull()).join(gone, F.col(key) == F.col(mine), "left_anti")
    first = Window.partitionBy(key).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    known = known.withColumn(copy, F.row_number().over(first)).filter(F.col(copy) == 1).drop(copy)
    return known.unionByName(rows.filter(F.col(key).isNull())).drop(key)

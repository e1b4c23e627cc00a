"""Language-model scores by a hashed maximum-entropy model with class-factored softmax.

The probability of a token is that of its class in its context, times that of the token within its class. Classes
are the OWN commonest tokens, one each, and groups of the rest by their last two bytes. The class factor is a
maximum-entropy model over hashed features of the context: the word before, the two words before together, and
each of the second and third words before alone (skips). The word factor is its add-one share of the class,
with one share for all unseen words; it needs only the corpus counts.

Spark counts the tokens of all training texts. Then every text is cut once more and stored as a row of token
numbers, from which the weights are trained and the texts are scored. Training is by distributed gradient updates: in
each round every task improves the current weights on its part of the training texts, and the mean of the results,
each weight's over the tasks that saw its feature and as often as they saw it, is the next round's start. Scoring works
in sparse numpy batches. The commonest FREQUENT tokens and their counts are broadcast; all others are handed on per
document and looked up by a join with the whole counts, so no token is left out and nothing that grows with the
corpus is broadcast.

Defined results: null and empty texts have one token, the end. A null ``doc_id`` hashes like an empty text
(it is trained on). Repeated rows and repeated ids give a row each. An empty table gives an empty
result; without training texts every count is 0. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, as_bytes, mixed, on_batches, only, pieces, staged

# The fold that is held out.
FOLDS = 7
HELD_OUT = 2

CLASSES = 32
OWN = 16
FREQUENT = 65_536
FEATURES = 1 << 15
ROUNDS = 2
RATE = 0.15
CHUNK = 8192  # tokens worked on at once
HELD_COUNTS = 300_000  # distinct tokens a task counts before it hands them on
SUMMED_TASKS = 16_384  # tasks that train side by side

# The end of a text, as a token: no word is empty.
END = b""


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def suffix_class(token: bytes) -> int:
    return OWN + zlib.crc32(token[-2:]) % (CLASSES - OWN)


# ---------------------------------------------------------------- counts

COUNTS = pa.schema([("token", pa.binary()), ("n", pa.int64()), ("suffix", pa.int64())])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush():
        tokens = list(counts)
        out = arrow_rows(COUNTS, [tokens, list(counts.values()), [suffix_class(t) for t in tokens]])
        counts.clear()
        return out

    for batch in batches:
        for part in pieces(batch, 200):
            for text in as_bytes(part):
                counts.update(text.lower().split())
            counts[END] += part.num_rows
            if len(counts) > HELD_COUNTS:
                yield flush()
    if counts:
        yield flush()


def token_counts(docs: DataFrame) -> DataFrame:
    """``token`` (bytes), ``n`` and ``suffix`` (its class if it has none of its own) over all of ``docs``."""
    found = on_batches(only(docs, "text"), _count_batches, "token binary, n bigint, suffix bigint")
    return found.groupBy("token").agg(F.sum("n").alias("n"), F.max("suffix").alias("suffix"))


class Vocabulary:
    """The frequent tokens with their counts, and the totals of the corpus by class."""

    def __init__(self, counts: DataFrame):
        top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
        self.tokens = [bytes(row["token"]) for row in top]
        self.classes = np.array(
            [k if k < OWN else row["suffix"] for k, row in enumerate(top)] + list(range(CLASSES)), np.int64
        )
        n = np.array([row["n"] for row in top], np.float64)
        self.log_counts = np.log10(n + 1)
        # All tokens by suffix class, less those that have a class of their own.
        totals = np.zeros(CLASSES)
        kinds = np.zeros(CLASSES)
        for row in counts.groupBy("suffix").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
            totals[row["suffix"]], kinds[row["suffix"]] = row["n"], row["v"]
        self.n_tokens, self.n_kinds = int(totals.sum()), int(kinds.sum())
        for k, row in enumerate(top[:OWN]):
            totals[row["suffix"]] -= row["n"]
            kinds[row["suffix"]] -= 1
            totals[k], kinds[k] = row["n"], 1
        self.class_logs = np.log10(totals + kinds + 1)
        self.prior = np.log((totals + 1) / (totals.sum() + CLASSES)).astype(np.float32)


class Numbers(dict):
    """Number of each token: its place among the frequent ones, else a number for its class."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__((token, k) for k, token in enumerate(vocabulary.tokens))
        self.rest = len(vocabulary.tokens)
        self.missed: list[bytes] = []

    def __missing__(self, token: bytes) -> int:
        self.missed.append(token)
        return self.rest + suffix_class(token)


# ---------------------------------------------------------------- model


def numbered_tokens(text: bytes, numbers: Numbers) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of a text's tokens, the end included, and the tokens that have none of their own."""
    found = [*map(numbers.__getitem__, text.lower().split()), numbers[END]]
    missed, numbers.missed = numbers.missed, []
    return np.array(found, np.int32), missed


def one_stream(rows: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts given as bytes of token numbers in a row, three pads before each; tokens per text."""
    pads = np.full(3, pad, np.int32).tobytes()
    stream = np.frombuffer(pads + pads.join(rows) if rows else b"", np.int32).astype(np.int64)
    return stream, np.array([len(row) // 4 for row in rows], np.int64)


def context_features(stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashed features of the contexts of the tokens at some places: one row each."""
    one, two, three = (stream[at - k].astype(np.uint64) for k in (1, 2, 3))
    factor = np.uint64(1_000_003)
    keys = np.stack(
        [one, (one + np.uint64(1)) * factor + two, two, three]
    ) + (np.arange(1, 5, dtype=np.uint64) << np.uint64(56))[:, None]
    return (mixed(keys) >> np.uint64(64 - 15)).astype(np.int64)


class Scratch:
    """Arrays for one chunk, used over and over: new ones of this size would come from the system each time."""

    def __init__(self) -> None:
        self.scores = np.empty((CHUNK, CLASSES), np.float32)
        self.more = np.empty((CHUNK, CLASSES), np.float32)


def class_scores(weights: np.ndarray, bias: np.ndarray, features: np.ndarray, scratch: Scratch) -> np.ndarray:
    n = features.shape[1]
    scores, more = scratch.scores[:n], scratch.more[:n]
    # Clipping changes nothing, all numbers are in range; without it the result is copied once more.
    np.take(weights, features[0], axis=0, out=scores, mode="clip")
    for row in features[1:]:
        np.take(weights, row, axis=0, out=more, mode="clip")
        scores += more
    scores += bias
    scores -= scores.max(axis=1, keepdims=True)
    return scores


def _places(sizes: np.ndarray) -> np.ndarray:
    """Places of the tokens in the stream: each text follows three pads."""
    return np.arange(sizes.sum()) + 3 * np.repeat(np.arange(1, len(sizes) + 1), sizes)


def log_probabilities(weights, bias, stream, at, classes, scratch: Scratch) -> np.ndarray:
    """Natural logarithm of the class factor of the tokens at ``at``."""
    out = np.empty(len(at), np.float64)
    for start in range(0, len(at), CHUNK):
        part = at[start : start + CHUNK]
        scores = class_scores(weights, bias, context_features(stream, part), scratch)
        own = scores[np.arange(len(part)), classes[start : start + CHUNK]]
        np.exp(scores, out=scores)
        out[start : start + CHUNK] = own - np.log(scores.sum(axis=1))
    return out


def train_on(weights, bias, squares, seen, stream, at, classes, scratch: Scratch) -> None:
    """One pass of adaptive gradient steps over the tokens at ``at``, in place; ``seen`` counts each feature."""
    for start in range(0, len(at), CHUNK):
        part = at[start : start + CHUNK]
        n = len(part)
        features = context_features(stream, part)
        step = class_scores(weights, bias, features, scratch)
        np.exp(step, out=step)
        step /= step.sum(axis=1, keepdims=True)
        step[np.arange(n), classes[start : start + CHUNK]] -= 1
        ranked_step = scratch.more[:n]
        for row in features:
            # 16-bit keys are sorted by radix.
            order = np.argsort(row.astype(np.uint16), kind="stable")
            ranked = row[order]
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            np.take(step, order, axis=0, out=ranked_step, mode="clip")
            # Two neighbouring classes are added as one complex number: half as many additions.
            total = np.add.reduceat(ranked_step.view(np.complex64), first, axis=0).view(np.float32)
            hit = ranked[first]
            seen[hit] += np.diff(first, append=n)
            squares[hit] += np.einsum("ij,ij->i", total, total) / CLASSES
            total *= (RATE / np.sqrt(squares[hit] + 1.0))[:, None]
            weights[hit] -= total


# ---------------------------------------------------------------- numbering

NUMBERED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("mark", pa.int64()),
        ("stream", pa.binary()),
        ("hits", pa.int64()),
        ("log_counts", pa.float64()),
        ("missed", pa.list_(pa.binary())),
        ("times", pa.list_(pa.int64())),
    ]
)
NUMBERED_DDL = (
    "doc_id bigint, held_out boolean, mark bigint, stream binary, hits bigint, log_counts double, "
    "missed array<binary>, times array<bigint>"
)


def _numbering(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        numbers = Numbers(vocabulary)
        logs = np.concatenate([vocabulary.log_counts, np.zeros(CLASSES)])
        for batch in batches:
            for part in pieces(batch, 200):
                texts = as_bytes(part)
                found = [numbered_tokens(text, numbers) for text in texts]
                counted = [Counter(missed) for _, missed in found]
                yield arrow_rows(
                    NUMBERED,
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        [xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts],
                        [stream.tobytes() for stream, _ in found],
                        [len(stream) - len(missed) for stream, missed in found],
                        [float(logs[stream].sum()) for stream, _ in found],
                        [list(c) for c in counted],
                        [list(c.values()) for c in counted],
                    ],
                )

    return run


def _training(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, start, bias = shared.value
        pad, scratch = len(classes), Scratch()
        weights, squares, seen = start.copy(), np.zeros(FEATURES, np.float32), np.zeros(FEATURES, np.int64)
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in pieces(batch, 200):
                    stream, sizes = one_stream(part.column("stream").to_pylist(), pad)
                    at = _places(sizes)
                    train_on(weights, bias, squares, seen, stream, at, classes[stream[at]], scratch)
        if seen.any():
            weights -= start
            schema = pa.schema([("change", pa.binary()), ("seen", pa.binary())])
            yield arrow_rows(schema, [[weights.tobytes()], [seen.tobytes()]])

    return run


def trained_weights(numbered: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Weights of FEATURES by CLASSES after ROUNDS rounds, each over its share of the training texts."""
    context = numbered.sparkSession.sparkContext
    weights = np.zeros((FEATURES, CLASSES), np.float32)
    bias = vocabulary.prior
    for number in range(ROUNDS):
        part = numbered.filter(~F.col("held_out") & (F.pmod(F.xxhash64("mark"), F.lit(ROUNDS)) == number)).select("stream")
        shared = context.broadcast((vocabulary.classes, weights, bias))
        changes = on_batches(part.coalesce(SUMMED_TASKS), _training(shared), "change binary, seen binary")

        def weighted(row):
            seen = np.frombuffer(row["seen"], np.int64)
            change = np.frombuffer(row["change"], np.float32).reshape(FEATURES, CLASSES)
            return change * seen[:, None].astype(np.float32), seen

        def add(x, y):
            return x[0] + y[0], x[1] + y[1]

        pairs = changes.rdd.map(weighted)
        nothing = (np.zeros((FEATURES, CLASSES), np.float32), np.zeros(FEATURES, np.int64))
        total, seen = pairs.treeAggregate(nothing, add, add, depth=3)
        weights = weights + total / np.maximum(seen, 1)[:, None].astype(np.float32)
    return weights


# ---------------------------------------------------------------- scoring

SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("mark", pa.int64()),
        ("n_tokens", pa.int64()),
        ("hits", pa.int64()),
        ("log_counts", pa.float64()),
        ("class_part", pa.float64()),
    ]
)
SCORED_DDL = (
    "doc_id bigint, held_out boolean, mark bigint, n_tokens bigint, hits bigint, log_counts double, class_part double"
)


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, class_logs, weights, bias = shared.value
        pad, scratch = len(classes), Scratch()
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in pieces(batch, 200):
                    stream, sizes = one_stream(part.column("stream").to_pylist(), pad)
                    at = _places(sizes)
                    own = classes[stream[at]]
                    factor = log_probabilities(weights, bias, stream, at, own, scratch) / np.log(10)
                    class_part = np.add.reduceat(factor - class_logs[own], np.cumsum(sizes) - sizes)
                    kept = [part.column(name) for name in ("doc_id", "held_out", "mark")]
                    yield arrow_rows(
                        SCORED, [*kept, sizes, part.column("hits"), part.column("log_counts"), class_part]
                    )

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    docs = only(docs, "doc_id", "text").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    context = docs.sparkSession.sparkContext
    counts = staged(token_counts(docs.filter(~F.col("held_out"))), "counts")
    vocabulary = Vocabulary(counts)
    numbered = staged(on_batches(docs, _numbering(context.broadcast(vocabulary)), NUMBERED_DDL), "numbered")
    weights = trained_weights(numbered, vocabulary)
    shared = context.broadcast((vocabulary.classes, vocabulary.class_logs, weights, vocabulary.prior))
    scored = on_batches(
        numbered.select("doc_id", "held_out", "mark", "stream", "hits", "log_counts"), _scoring(shared), SCORED_DDL
    )

    # Rows alike in id and text miss the same tokens: their sum is shared out among them.
    rare = numbered.filter(F.size("missed") > 0).select("doc_id", "mark", "missed", "times")
    missed = rare.select("doc_id", "mark", F.explode(F.arrays_zip("missed", "times")).alias("m")).select(
        "doc_id", "mark", F.col("m.missed").alias("token"), F.col("m.times").alias("times")
    )
    zero = F.lit(0).cast("bigint")
    looked_up = missed.join(counts.select("token", "n"), "token").select(
        "doc_id",
        "mark",
        zero.alias("copies"),
        F.col("times").alias("known"),
        (F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs"),
    )
    copies = rare.select("doc_id", "mark", F.lit(1).cast("bigint").alias("copies"), zero.alias("known"), F.lit(0.0).alias("rare_logs"))
    sums = copies.unionByName(looked_up).groupBy("doc_id", "mark").agg(
        *[F.sum(c).alias(c) for c in ("copies", "known", "rare_logs")]
    )
    same = F.col("s.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("s.mark") == F.col("r.mark"))
    known = F.coalesce(F.col("r.known") / F.col("r.copies"), F.lit(0.0))
    logs = F.col("s.log_counts") + F.coalesce(F.col("r.rare_logs") / F.col("r.copies"), F.lit(0.0))
    base = float(np.log10(vocabulary.n_tokens + vocabulary.n_kinds + 1))
    return (
        scored.alias("s")
        .join(sums.alias("r"), same, "left")
        .select(
            "s.doc_id",
            "s.held_out",
            "s.n_tokens",
            (F.col("s.hits") + known.cast("bigint")).alias("n_known"),
            F.lit(vocabulary.n_tokens).cast("bigint").alias("train_tokens"),
            (logs - F.col("s.n_tokens") * base).alias("base_score"),
            (logs + F.col("s.class_part")).alias("score"),
        )
    )

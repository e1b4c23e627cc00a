"""Toxicity by a counterfactual-regularised classifier.

A logistic model on shares of words and of their first letters (hashed). It is fitted on labelled documents with a
further penalty: every labelled sentence that mentions a group of people (``IDENTITY_TERMS``) is paired with the
same sentence naming another group of its kind, and the squared change of the score counts as a loss. So what
a toxic sentence says about a group is learnt, but not the group's name, and neutral mentions keep low scores.

The sample fitted on: about TOXIC and CLEAN documents (all, if there are fewer), chosen by a hash of the id among
the labelled ones. Which of the 65,536 features tell toxic from clean is measured on the executors (Welch's t), the
KEPT clearest are fitted in the driver. Every document is scored, in batches on the executors.

Defined results: null and empty texts, and texts without a letter, have no word to judge and score 0. A null ``doc_id`` hashes like an empty text. Repeated rows get repeated scores; a document is toxic where
any label row of its id says so, rows with other values than 0 and 1 are no labels. Without labels of both kinds
every score is 0. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, on_batches, only, pieces

# The fold that is held out, and the score from which a document counts as toxic.
FOLDS = 4
HELD_OUT = 2
PREDICTED = 0.3

# Documented bounds of the sample the classifier is fitted on.
TOXIC = 8_000
CLEAN = 16_000

HASHED = 1 << 16
BLOCK = 1 << 12
KEPT = 4_096
HEADS = (3, 4, 5)  # first letters of a word that are a feature as well
SCALE = 50.0  # a word in fifty counts as 1
STEPS = 300
RATE = 0.05
SHRINK = 0.0005
EVENNESS = 10.0  # weight of the counterfactual penalty
PAIRS = 2  # counterfactuals of a sentence
REMEMBERED = 200_000

# Terms of one kind, by language; a term may be swapped with any other of its line.
IDENTITY_TERMS = [
    "women men girls boys",
    "woman man girl boy",
    "christians muslims jews hindus buddhists atheists",
    "christian muslim jewish hindu buddhist atheist",
    "gay straight lesbian bisexual transgender",
    "black white asian latino african european american",
    "immigrants refugees foreigners natives",
    "frauen männer mädchen jungen",
    "christen muslime juden hindus buddhisten",
    "ausländer einwanderer flüchtlinge einheimische",
    "femmes hommes filles garçons",
    "chrétiens musulmans juifs hindous bouddhistes",
    "immigrés réfugiés étrangers autochtones",
    "mujeres hombres chicas chicos",
    "cristianos musulmanes judíos hindúes budistas",
    "inmigrantes refugiados extranjeros nativos",
]

_LETTERS = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_KINDS = [line.split() for line in IDENTITY_TERMS]
_KIND_OF = {term: kind for kind in _KINDS for term in kind}

SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)
SCORED_DDL = "doc_id bigint, held_out boolean, score double, predicted int"


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


class _Features:
    """Feature numbers of a word, remembered for the words met last."""

    def __init__(self, kept: np.ndarray | None = None):
        self.place = None if kept is None else {int(f): i for i, f in enumerate(kept)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            import xxhash

            marks = [word, *[f"{word[:n]}-" for n in HEADS if len(word) >= n]]
            hashed = [xxhash.xxh64_intdigest(mark.encode("utf-8", "replace")) % HASHED for mark in marks]
            if self.place is not None:
                hashed = [self.place[f] for f in hashed if f in self.place]
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = tuple(hashed)
        return found

    def row(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, scaled shares) of a text."""
        counts: Counter[int] = Counter()
        for word, n in Counter(words).items():
            for feature in self.of(word):
                counts[feature] += n
        features = np.fromiter(counts.keys(), np.int64, len(counts))
        shares = np.fromiter(counts.values(), np.float64, len(counts)) * (SCALE / max(1, len(words)))
        return features, shares


def counterfactuals(text: str, pairs: int = PAIRS) -> list[tuple[list[str], list[str]]]:
    """(words of a sentence, the same with another group's name) for the sentences that mention one.

    The terms that follow in the kind's line are taken, so that the pairs do not depend on chance.
    """
    found = []
    for sentence in _SENTENCE.findall(text.lower()):
        words = _LETTERS.findall(sentence)
        if not any(word in _KIND_OF for word in words):
            continue
        for shift in range(1, pairs + 1):
            swapped = [_swapped(word, shift) for word in words]
            if swapped != words:
                found.append((words, swapped))
    return found


def _swapped(word: str, shift: int) -> str:
    kind = _KIND_OF.get(word)
    return word if kind is None else kind[(kind.index(word) + shift) % len(kind)]


SUMS = pa.schema([("toxic", pa.int32()), ("block", pa.int32()), ("n", pa.int64()), ("sums", pa.binary())])
SUMS_DDL = "toxic int, block int, n bigint, sums binary"


def _summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of the shares and of their squares, by label."""
    features, sums, n = _Features(), np.zeros((2, HASHED, 2)), [0, 0]
    for batch in batches:
        labels = batch.column("toxic").to_pylist()
        for toxic, text in zip(labels, batch.column("text").to_pylist(), strict=True):
            numbers, shares = features.row(_words(text or ""))
            sums[toxic, numbers, 0] += shares
            sums[toxic, numbers, 1] += shares**2
            n[toxic] += 1
    for toxic in (0, 1):
        if n[toxic]:
            parts = sums[toxic].astype(np.float32).reshape(-1, BLOCK * 2)
            count = [n[toxic]] * len(parts)
            yield arrow_rows(SUMS, [[toxic] * len(parts), range(len(parts)), count, [p.tobytes() for p in parts]])


def _adding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of tasks added up; one row of each (label, block) met."""
    total: dict[tuple[int, int], list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            part = np.frombuffer(row["sums"], np.float32).astype(float)
            held = total.setdefault((row["toxic"], row["block"]), [0, 0.0])
            held[0] += row["n"]
            held[1] = held[1] + part
    if total:
        rows = [(toxic, block, n, part.astype(np.float32).tobytes()) for (toxic, block), (n, part) in total.items()]
        yield arrow_rows(SUMS, zip(*rows, strict=True))


def clearest_features(sample: DataFrame) -> np.ndarray:
    """The KEPT features whose shares differ most between toxic and clean documents, in ascending order."""
    tasks = on_batches(sample.select("toxic", "text"), _summing, SUMS_DDL)
    rows = on_batches(tasks.repartition("block"), _adding, SUMS_DDL).collect()
    sums, n = np.zeros((2, HASHED // BLOCK, BLOCK, 2)), [0, 0]
    for row in rows:
        sums[row["toxic"], row["block"]] += np.frombuffer(row["sums"], np.float32).reshape(BLOCK, 2)
        n[row["toxic"]] = row["n"]
    if min(n) == 0:
        return np.zeros(0, np.int64)
    shape = np.array(n, float).reshape(2, 1)
    means = sums[..., 0].reshape(2, HASHED) / shape
    spread = np.maximum(sums[..., 1].reshape(2, HASHED) / shape - means**2, 0) / shape
    # A feature met once in a small sample has a spread too small to be true.
    floor = (SCALE / 1000) ** 2 / shape.min()
    clear = np.abs(means[1] - means[0]) / np.sqrt(spread.sum(axis=0) + floor)
    clear[sums[..., 0].sum(axis=0).reshape(HASHED) == 0] = 0
    best = np.argsort(-clear, kind="stable")[:KEPT]
    return np.sort(best[clear[best] > 0])


ROWS = pa.schema(
    [("toxic", pa.int32()), ("numbers", pa.binary()), ("shares", pa.binary())]
)
ROWS_DDL = "toxic int, numbers binary, shares binary"


def _encoding(shared):
    """Rows for the driver: a document's kept features, and (toxic -1) the differences of its counterfactuals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(shared.value)

        def packed(toxic: int, numbers: np.ndarray, shares: np.ndarray) -> tuple:
            return toxic, numbers.astype(np.int32).tobytes(), shares.astype(np.float32).tobytes()

        for batch in batches:
            for part in pieces(batch):
                rows = []
                for toxic, text in zip(part.column("toxic").to_pylist(), part.column("text").to_pylist(), strict=True):
                    rows.append(packed(toxic, *features.row(_words(text or ""))))
                    for words, swapped in counterfactuals(text or ""):
                        (a, b), (c, d) = features.row(words), features.row(swapped)
                        rows.append(packed(-1, np.concatenate([a, c]), np.concatenate([b, -d])))
                yield arrow_rows(ROWS, zip(*rows, strict=True))

    return run


class _Sparse:
    """Rows of (feature, value) pairs."""

    def __init__(self, rows: list[tuple[bytes, bytes]], width: int):
        self.width, self.n = width, len(rows)
        self.numbers = np.frombuffer(b"".join(r[0] for r in rows), np.int32)
        self.values = np.frombuffer(b"".join(r[1] for r in rows), np.float32).astype(float)
        self.row = np.repeat(np.arange(self.n), [len(r[0]) // 4 for r in rows])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * weights[self.numbers], self.n)

    def back(self, each: np.ndarray) -> np.ndarray:
        return np.bincount(self.numbers, self.values * each[self.row], self.width)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: _Sparse, toxic: np.ndarray, swaps: _Sparse, evenness: float = EVENNESS) -> np.ndarray:
    """Weights (last one the intercept) of least mean logistic loss, plus ``evenness`` times the mean squared change."""
    width = rows.width
    w = np.zeros(width + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        wrong = (_sigmoid(rows.times(w) + w[-1]) - toxic) / rows.n
        grad = np.append(rows.back(wrong) + SHRINK * w[:-1], wrong.sum())
        if swaps.n:
            grad[:-1] += swaps.back(swaps.times(w) * (2 * evenness / swaps.n))
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``toxic`` and ``text`` of about TOXIC and CLEAN labelled documents outside the held-out fold, each text once."""
    known = only(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(fold(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, _parts(TOXIC, n.get(1, 0))).otherwise(_parts(CLEAN, n.get(0, 0)))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share)
    # The broadcast side is the sample of ids; a text that many rows repeat is taken once.
    rows = only(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.select("toxic", "text").distinct()


def _parts(bound: int, n: int) -> int:
    return 1_000_000 if n <= bound else 1_000_000 * bound // n


class Classifier:
    """Kept features and their weights."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray | None):
        self.kept, self.weights = kept, weights

    def scores(self, texts: list[str], features: _Features) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        return np.array([self._score(features, _words(text)) for text in texts])

    def _score(self, features: _Features, words: list[str]) -> float:
        if not words:
            return 0.0
        numbers, shares = features.row(words)
        return float(_sigmoid(shares @ self.weights[numbers] + self.weights[-1]))


def fitted(docs: DataFrame, labels: DataFrame, evenness: float = EVENNESS) -> Classifier:
    sample = labelled_sample(docs, labels)
    kept = clearest_features(sample)
    if not len(kept):
        return Classifier(kept, None)
    shared = docs.sparkSession.sparkContext.broadcast(kept)
    rows = on_batches(sample, _encoding(shared), ROWS_DDL).collect()
    texts = [r for r in rows if r["toxic"] >= 0]
    toxic = np.array([r["toxic"] for r in texts], float)
    swaps = [(bytes(r["numbers"]), bytes(r["shares"])) for r in rows if r["toxic"] < 0]
    matrix = _Sparse([(bytes(r["numbers"]), bytes(r["shares"])) for r in texts], len(kept))
    return Classifier(kept, fit(matrix, toxic, _Sparse(swaps, len(kept)), evenness))


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        features = _Features(model.kept)
        for batch in batches:
            for part in pieces(batch):
                scores = model.scores([text or "" for text in part.column("text").to_pylist()], features)
                predicted = (scores >= PREDICTED).astype(np.int32)
                yield arrow_rows(SCORED, [part.column("doc_id"), part.column("held_out"), scores, predicted])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, evenness: float = EVENNESS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, evenness))
    rows = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint"), "text", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out")
    )
    return on_batches(rows, _scoring(shared), SCORED_DDL)

"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled are a sample of all training documents, whatever
their label, which is never read for them. The share of good ones among the unlabelled (the class prior) is
estimated as the least ratio of unlabelled to positive mass above a score, over the scores of a first
classifier that tells positives from unlabelled. The classifier then minimises the non-negative unbiased risk:
prior * loss of positives as good + max(0, loss of unlabelled as bad - prior * loss of positives as bad).

Features are measures of the text alone: its length, its words, signs, repetition, and the frequencies of
hashed byte pairs. About POSITIVES and UNLABELLED documents (all, if there are fewer), chosen by a hash of id and text, are
fitted on, in the driver; rows that repeat both count once, and a sample beyond its bound by a half is refused. Every
document is scored, in numpy batches on the executors.

Defined results: null and empty texts are scored by the features of a text without words. A null ``doc_id``
hashes like an empty text. Repeated rows give repeated scores; repeated or null labels count as good where one
of them is. Without positives every score is the prior's default, 0.5. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, as_bytes, on_batches, only, pieces

# The fold that is held out, and the score from which a document counts as good.
FOLDS = 5
HELD_OUT = 0
GOOD = 0.3

# Documented bounds of the sample the classifier is fitted on.
POSITIVES = 10_000
UNLABELLED = 20_000

STEPS = 400
RATE = 0.05
SHRINK = 5.0  # pull of the weights to zero, divided by the number of documents fitted on
PAIRS = 64
SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:?"

SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)
SCORED_DDL = "doc_id bigint, held_out boolean, score double, predicted int"


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def _share(text: bytes, signs: bytes, n: int) -> float:
    return (len(text) - len(text.translate(None, signs))) / n


_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))


def features(text: bytes) -> np.ndarray:
    """Measures of one text; shares are scaled so that common values stay near 0 to 1."""
    words = text.split()
    n = max(1, len(words))
    size = max(1, len(text))
    counts: dict[bytes, int] = {}
    numbers = np.fromiter((counts.setdefault(w, len(counts)) for w in words), np.int64, len(words))
    most = int(np.bincount(numbers).max()) / n if words else 0.0
    if len(words) > 2:
        threes = (numbers[:-2] * len(counts) + numbers[1:-1]) * len(counts) + numbers[2:]
        repeated = 1 - len(np.unique(threes)) / len(threes)
        same = float(np.mean(numbers[1:] == numbers[:-1]))
    else:
        repeated = same = 0.0
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = max(1, len(text) - len(text.translate(None, _UPPER + _LOWER)))
    upper = (len(text) - len(text.translate(None, _UPPER))) / letters
    symbols = _share(text, SYMBOLS, n)
    shouts = _share(text, b"!", n)
    dense = [
        np.log1p(len(words)) / 8,
        1.0 if len(words) < 20 else 0.0,
        size / n / 10,
        len(counts) / n,
        most,
        min(1.0, 4 * most),
        repeated,
        min(1.0, 4 * repeated),
        same,
        min(1.0, 10 * same),
        1 - len(set(lines)) / max(1, len(lines)),
        upper,
        min(1.0, 2 * upper),
        min(2.0, symbols),
        min(1.0, 5 * symbols),
        min(2.0, shouts),
        min(1.0, 5 * shouts),
        min(2.0, _share(text, b"|", n)),
        min(1.0, 5 * _share(text, b"|", n)),
        min(2.0, _share(text, _DIGITS, n)),
        min(2.0, _share(text, MARKS, n)),
    ]
    data = np.frombuffer(text, np.uint8)
    if len(data) > 1:
        pairs = (data[:-1].astype(np.uint32) * np.uint32(40503) + data[1:] * np.uint32(60493)) >> np.uint32(7)
        hashed = np.sqrt(np.bincount(pairs % PAIRS, minlength=PAIRS) / len(pairs))
    else:
        hashed = np.zeros(PAIRS)
    return np.concatenate([dense, hashed]).astype(np.float32)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("features", pa.binary())])
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in pieces(batch):
                yield arrow_rows(schema, [[features(text).tobytes() for text in as_bytes(part)]])


def _matrix(docs: DataFrame, bound: int) -> np.ndarray:
    rows = on_batches(docs.select("text"), _feature_batches, "features binary").limit(_most(bound) + 1).collect()
    if len(rows) > _most(bound):
        raise ValueError(f"a sample of about {bound} documents has more than {_most(bound)}")
    width = len(features(b""))
    return np.frombuffer(b"".join(bytes(r["features"]) for r in rows), np.float32).reshape(-1, width).astype(float)


def _most(bound: int) -> int:
    """Rows that a sample by hash stays below, but for a chance that is not worth a number."""
    return bound + bound // 2 + 100


def _sample(df: DataFrame, size: int, *columns: str) -> DataFrame:
    """About ``size`` different rows of ``df`` (all, if there are fewer), by a hash of the columns that tell them apart."""
    n = df.count()
    share = min(1.0, size / max(n, 1))
    hashed = F.pmod(F.xxhash64(*columns, F.lit("sample")), F.lit(1_000_000))
    return df.filter(hashed < int(share * 1_000_000)).dropDuplicates(list(columns))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(good: np.ndarray, rest: np.ndarray, prior: float | None) -> np.ndarray:
    """Weights (last one the intercept). Without a prior: positives against unlabelled, as if those were bad."""
    w = np.zeros(good.shape[1])
    shrink = SHRINK / (len(good) + len(rest))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p, u = _sigmoid(good @ w), _sigmoid(rest @ w)
        if prior is None:
            grad = good.T @ (p - 1) / len(good) + rest.T @ u / len(rest)
        else:
            as_good = good.T @ (p - 1) / len(good)
            as_bad = rest.T @ u / len(rest) - prior * (good.T @ p) / len(good)
            # Logistic loss of calling a bad one good: log(1 + exp(score)).
            risk = np.mean(np.logaddexp(0, rest @ w)) - prior * np.mean(np.logaddexp(0, good @ w))
            grad = prior * as_good + as_bad if risk >= 0 else -as_bad
        grad = grad + shrink * w
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def class_prior(good: np.ndarray, rest: np.ndarray) -> float:
    """Least ratio of unlabelled to positive mass above a score; scores that keep a fifth of the positives count."""
    levels = np.quantile(good, np.linspace(0.02, 0.8, 40))
    ratios = [np.mean(rest >= t) / np.mean(good >= t) for t in levels]
    return float(np.clip(min(ratios), 0.05, 0.99))


class Classifier:
    def __init__(self, good: np.ndarray, rest: np.ndarray):
        both = np.concatenate([good, rest])
        self.centre = both.mean(axis=0) if len(both) else 0.0
        self.spread = both.std(axis=0) + 1e-6 if len(both) else 1.0
        self.weights = None
        self.prior = 0.5
        if len(good) and len(rest):
            good, rest = self._scaled(good), self._scaled(rest)
            self.prior = self._prior(good, rest)
            self.weights = _fit(good, rest, self.prior)

    @staticmethod
    def _prior(good: np.ndarray, rest: np.ndarray) -> float:
        """Each half is judged by what was fitted on the other: a text in both samples must not count twice."""
        if min(len(good), len(rest)) < 4:
            return 0.5
        priors = []
        for k in (0, 1):
            w = _fit(good[k::2], rest[k::2], None)
            priors.append(class_prior(good[1 - k :: 2] @ w, rest[1 - k :: 2] @ w))
        return float(np.mean(priors))

    def _scaled(self, rows: np.ndarray) -> np.ndarray:
        rows = np.clip((rows - self.centre) / self.spread, -5, 5)
        return np.concatenate([rows, np.ones((len(rows), 1))], axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.prior)
        return _sigmoid(self._scaled(rows) @ self.weights)


def fitted(docs: DataFrame, labels: DataFrame) -> Classifier:
    docs, labels = only(docs, "doc_id", "text"), only(labels, "doc_id", "quality")
    training = fold(F.col("doc_id")) != HELD_OUT
    good = _sample(labels.filter(training & (F.col("quality") == 1)).select("doc_id").distinct(), POSITIVES, "doc_id")
    # The broadcast side is the sample of ids, about POSITIVES of them; an id may have several texts.
    positives = docs.filter(training).join(F.broadcast(good), "doc_id", "left_semi")
    positives = _sample(positives, POSITIVES, "doc_id", "text")
    unlabelled = _sample(docs.filter(training), UNLABELLED, "doc_id", "text")
    return Classifier(_matrix(positives, POSITIVES), _matrix(unlabelled, UNLABELLED))


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in pieces(batch):
                    scores = model.scores(np.array([features(text) for text in as_bytes(part)], float))
                    yield arrow_rows(
                        SCORED,
                        [part.column("doc_id"), part.column("held_out"), scores, (scores >= GOOD).astype(np.int32)],
                    )

    return run


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    rows = only(docs, "doc_id", "text").select(
        "doc_id", "text", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out")
    )
    return on_batches(rows, _scoring(shared), SCORED_DDL)

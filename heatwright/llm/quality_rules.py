"""Quality rules by repetition coverage: how much of a text lies inside repeated n-grams and lines.

Words are numbered per text; one polynomial prefix sum over them gives the rolling hash of every window of
any length, so each n-gram length costs one subtraction and one sort. A repeated long window contains
repeated shorter ones, so texts without a repeated shortest window skip the rest.

Null and empty texts have no words: all measures 0, ``base_failed``, not kept. Rows are judged alone:
repeated rows, repeated ids and null ids each give their own row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from heatwright.llm.texts import arrow_rows, as_bytes, code_points, mixed, on_batches, only, pieces

# The base rule.
MIN_WORDS = 20
BASE_WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"

# Largest percentage of a text's word characters that may lie in windows of so many words which repeat an
# earlier window of the text (the first occurrence is no repetition).
COVERAGE_LIMITS = {4: 25, 6: 20, 10: 15}
# The same for lines equal to an earlier line, by characters of their words.
LINE_LIMIT = 30
# Symbols per hundred words.
SYMBOL_LIMIT = 20

_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)

MEASURES = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[
            (name, pa.int64())
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("dup_line_chars", pa.int64()),
        *[(f"dup_{n}gram_chars", pa.int64()) for n in COVERAGE_LIMITS],
    ]
)
MEASURES_DDL = ", ".join(
    f"{f.name} {'boolean' if pa.types.is_boolean(f.type) else 'bigint'}" for f in MEASURES
)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _cover(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    change[starts] += 1
    change[starts + size] -= 1
    return np.cumsum(change[:-1]) > 0


def repeated_words(prefix: np.ndarray, back: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the words inside windows of ``size`` words that occur twice or more: all, and without firsts."""
    n = len(prefix) - 1
    none = np.zeros(n, bool)
    if n - size < 1:
        return none, none
    windows = (prefix[size:] - prefix[:-size]) * back[: n - size + 1]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return none, none
    again = order[1:][same]
    return _cover(np.union1d(again, order[:-1][same]), size, n), _cover(again, size, n)


def measure(text: bytes) -> tuple:
    """The measures of one text, from ``n_words`` on."""
    words = text.split()
    n = len(words)
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    sized = words if text.isascii() else b" ".join(words).decode().split(" ")
    chars = np.fromiter(map(len, sized), np.int64, n)
    total = int(chars.sum())

    seen: set[bytes] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup_lines += 1
            dup_line_chars += code_points(b"".join(line.split()))
        elif line.strip():
            seen.add(line)

    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(ids + np.uint64(1)) * _powers(_STEP, n), out=prefix[1:])
    back = _powers(_BACK, n)

    covered = {}
    none = False
    for size in sorted({*COVERAGE_LIMITS, BASE_WINDOW}):
        marks = (np.zeros(n, bool),) * 2 if none else repeated_words(prefix, back, size)
        none = not marks[0].any()
        covered[size] = marks
    repeat = int(covered[BASE_WINDOW][0].sum())
    dup_chars = [int(chars[covered[size][1]].sum()) for size in COVERAGE_LIMITS]

    failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n
    kept = (
        not failed
        and all(100 * c <= limit * total for c, limit in zip(dup_chars, COVERAGE_LIMITS.values(), strict=True))
        and 100 * dup_line_chars <= LINE_LIMIT * total
        and 100 * n_symbols <= SYMBOL_LIMIT * n
    )
    return (n, total, n_symbols, dup_lines, repeat, failed, kept, dup_line_chars, *dup_chars)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in pieces(batch):
                found = [measure(text) for text in as_bytes(part)]
                yield arrow_rows(MEASURES, [part.column("doc_id"), *zip(*found, strict=True)])


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base measures, the coverage measures and ``kept``, one row per row of ``docs``."""
    return on_batches(only(docs, "doc_id", "text"), _measure_batches, MEASURES_DDL)


def _keep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for part in pieces(batch):
                kept = [measure(text)[6] for text in as_bytes(part)]
                yield part.filter(pa.array(kept, pa.bool_()))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    return on_batches(docs, _keep_batches, docs.schema)

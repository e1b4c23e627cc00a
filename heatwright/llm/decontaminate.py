"""Benchmark decontamination by the q-gram lemma and banded alignment.

A benchmark item of m characters that occurs in a text with at most k edits shares m - q + 1 - k * q of its
q-grams with it, all within k diagonals of each other. Texts and items are normalised alike, in characters: case
folded and compatibility forms composed (NFKC) in any script, format characters dropped, every run of blanks,
punctuation and other ASCII characters than letters and digits one blank. Their q-grams are hashed at every offset
from two 64-bit reads, of one byte a character: characters that share a byte only add candidates. A bitmap of the items' grams marks candidate offsets; only stretches dense enough for
some item go on to exact look-up, where the shared grams are counted per item in overlapping diagonal bands.
Bands that reach the item's bound are aligned within the band, and a hit is an alignment within the budget.

Different item texts are read in parts of about PART_BYTES bytes, one pass over the documents each, so what is
sent to the executors stays as small however large the benchmark is and however often it repeats an item. Hits
are joined with the rows of the benchmark by a hash of the text.

Defined results: null and empty texts and items hit nothing. Items too short for the lemma's bound to be
positive must occur exactly (normalised) and as whole words, where their script parts words; those without a letter or digit never do. Repeated rows, repeated
ids and null ids are judged row by row; repeated items give a row each. Other columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, as_bytes, on_batches, only, pieces

# Q-gram length, from 8 to 16.
Q = 12
# Edits allowed, as a percentage of the item's normalised length.
EDIT_PERCENT = 5
# Lengths of the stretch of text in which candidate offsets are counted first; the most telling one is used.
STRETCHES = range(16, 129)
# Offsets of an unrelated text that are candidates, roughly; it only serves the choice of the stretch.
CHANCE = 0.1
PART_BYTES = 4_000_000

HITS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("span_start", pa.int64()),
        ("span_end", pa.int64()),
        ("edits", pa.int64()),
    ]
)
HITS_DDL = "doc_id bigint, item_id bigint, span_start bigint, span_end bigint, edits bigint"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
for _code in range(128):
    if not chr(_code).isalnum():
        _FOLD[_code] = 32
_FOLD_TABLE = _FOLD.tobytes()
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = np.uint64(0xD6E8FEB86659FD93)

# What each character folds to, worked out when it is first met: itself, one other, or one of these.
_UNKNOWN, _SEVERAL, _EXTENDS = -1, -2, -3
_FOLDED = np.full(0x110000, _UNKNOWN, np.int32)
_FOLDED[:128] = _FOLD[:128]
# Scripts that put no blanks between words: Thai to Lao, Myanmar, Khmer, kana and Han.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x31FF), (0x3400, 0x9FFF))
UNSPACED += ((0xF900, 0xFAFF), (0x20000, 0x3FFFF))


@lru_cache(100_000)
def folded_cluster(cluster: str) -> tuple[int, ...]:
    """What a character and the marks on it fold to: any number of code points."""
    composed = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", cluster).casefold())
    out = []
    for letter in composed:
        kind = unicodedata.category(letter)
        if letter < "\x80":
            out.append(int(_FOLD[ord(letter)]))
        elif kind[0] in "PZ" or kind == "Cc":
            out.append(32)
        elif kind != "Cf":
            out.append(ord(letter))
    return tuple(out)


def _learn(letters: np.ndarray) -> None:
    for code in letters.tolist():
        lead = unicodedata.normalize("NFKD", chr(code))[0]
        if unicodedata.category(lead)[0] == "M" or 0x1160 <= ord(lead) <= 0x11FF:
            _FOLDED[code] = _EXTENDS
        else:
            out = folded_cluster(chr(code))
            _FOLDED[code] = out[0] if len(out) == 1 else _SEVERAL


def _folded_points(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points, and the first character of the text that each stands for and the one after its last."""
    points = np.frombuffer(text.decode(errors="replace").encode("utf-32-le"), "<u4")
    codes = _FOLDED[points]
    if (codes == _UNKNOWN).any():
        _learn(np.unique(points[codes == _UNKNOWN]))
        codes = _FOLDED[points]
    first = np.arange(len(points))
    if codes.min() >= 0:
        return codes, first, first + 1
    # Marks go with the character before them; a cluster that is not one plain character is folded as a whole.
    first = np.flatnonzero((codes != _EXTENDS) | (first == 0))
    stop = np.append(first[1:], len(points))
    codes = codes[first]
    special = np.flatnonzero((codes < 0) | (stop - first > 1))
    outs = [
        folded_cluster(points[a:b].tobytes().decode("utf-32-le"))
        for a, b in zip(first[special].tolist(), stop[special].tolist(), strict=True)
    ]
    sizes = np.ones(len(codes), np.int64)
    sizes[special] = [len(out) for out in outs]
    whole = np.repeat(codes, sizes)
    inside = np.ones(len(codes), bool)
    inside[special] = False
    whole[~np.repeat(inside, sizes)] = [code for out in outs for code in out]
    return whole, np.repeat(first, sizes), np.repeat(stop, sizes)


def normalised(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters (bytes, if ``text`` is ASCII), and the span of ``text`` in code points each stands for."""
    if text.isascii():
        folded = np.frombuffer(text.translate(_FOLD_TABLE), np.uint8)
        first = np.arange(len(folded))
        stop = first + 1
    else:
        folded, first, stop = _folded_points(text)
    blank = folded == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return folded[keep], first[keep], stop[keep]


def as_text(folded: np.ndarray) -> str:
    return folded.tobytes().decode("ascii" if folded.dtype == np.uint8 else "utf-32-le")


def letters_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def one_byte(folded: np.ndarray) -> np.ndarray:
    """A byte for each character; those beyond ASCII share 128 of them."""
    if folded.dtype == np.uint8:
        return folded
    return np.where(folded < 128, folded, folded & 127 | 128).astype(np.uint8)


def _parted(left: str, right: str) -> bool:
    """Whether a word may end between two neighbouring characters."""
    return " " in (left, right) or any(a <= ord(c) <= b for c in (left, right) for a, b in UNSPACED)


def whole_word(item: str, text: str) -> int:
    """Place of the first occurrence of the item as whole words, or -1; the text begins and ends with a blank."""
    place = text.find(item)
    while place >= 0:
        end = place + len(item)
        if _parted(text[place - 1], item[0]) and _parted(item[-1], text[end]):
            return place
        place = text.find(item, place + 1)
    return -1


def grams(folded: np.ndarray) -> np.ndarray:
    """The q-gram at every offset as one number, from the bytes of its first and its last eight characters."""
    folded = one_byte(folded)
    n = len(folded) - 7
    if n < Q - 7:
        return np.zeros(0, np.uint64)
    eights = np.ndarray((n,), "<u8", buffer=np.ascontiguousarray(folded), strides=(1,)).astype(np.uint64)
    eights *= _MIX
    return eights[: n - Q + 8] ^ (eights[Q - 8 :] * _LAST)


@dataclass
class Item:
    item_id: int | None
    text: str
    budget: int
    bound: int


class ItemIndex:
    """Grams of some items: bitmap, sorted look-up, and what an occurrence of each item needs."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.items: list[Item] = []
        self.short: list[Item] = []
        for item_id, text in items:
            data = as_text(normalised((text or "").encode())[0]).strip(" ")
            if not data:
                continue
            m = len(data)
            budget = m * EDIT_PERCENT // 100
            bound = m - Q + 1 - budget * Q
            (self.items if bound > 0 else self.short).append(Item(item_id, data, budget, bound))
        found, owner, place = [], [], []
        for k, item in enumerate(self.items):
            own = grams(letters_of(item.text))
            found.append(own)
            owner.append(np.full(len(own), k, np.int32))
            place.append(np.arange(len(own), dtype=np.int32))
        every = np.concatenate(found) if found else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.owner = np.concatenate(owner)[order] if found else np.zeros(0, np.int32)
        self.place = np.concatenate(place)[order] if found else np.zeros(0, np.int32)
        self.keys, self.first = np.unique(every[order], return_index=True)
        self.first = np.append(self.first, len(every))
        bits = max(16, int(np.ceil(np.log2(len(self.keys) + 1))) + 4)
        self.shift = np.uint64(64 - bits)
        self.bitmap = np.zeros(1 << bits, bool)
        self.bitmap[(self.keys * _MIX) >> self.shift] = True
        self.bounds = np.array([i.bound for i in self.items], np.int64)
        self.halves = np.array([i.budget + 1 for i in self.items], np.int64)
        windows = np.array([len(i.text) + i.budget for i in self.items], np.int64)
        self.reach = int(windows.max(initial=0))
        # Cut an occurrence into stretches: one of them holds at least its share of the item's bound.
        shares = {n: int((-(-self.bounds // -(-windows // n))).min(initial=n)) for n in STRETCHES}
        self.stretch = max(shares, key=lambda n: (shares[n] - CHANCE * n) / n**0.5)
        self.least = shares[self.stretch]

    def candidates(self, folded: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, lowest diagonal, highest diagonal) of the bands that reach their item's bound."""
        own = grams(folded)
        if not len(own) or not len(self.keys):
            return []
        marked = self.bitmap[(own * _MIX) >> self.shift]
        total = np.zeros(len(marked) + 1, np.int32)
        np.cumsum(marked, out=total[1:])
        if total[-1] < self.least:
            return []
        if len(marked) > self.stretch:
            starts = np.flatnonzero(total[self.stretch :] - total[: -self.stretch] >= self.least)
        else:
            starts = np.zeros(1, np.int64)
        if not len(starts):
            return []
        # A marked offset counts if some dense stretch holds it or an occurrence reaches from there to it.
        reach = self.reach
        breaks = np.flatnonzero(np.diff(starts) > 2 * reach + self.stretch)
        first = np.maximum(starts[np.concatenate([[0], breaks + 1])] - reach, 0)
        last = np.minimum(starts[np.concatenate([breaks, [-1]])] + self.stretch + reach, len(marked))
        at = np.concatenate([a + np.flatnonzero(marked[a:b]) for a, b in zip(first, last, strict=True)])
        slot = np.searchsorted(self.keys, own[at])
        slot[slot == len(self.keys)] = 0
        true = self.keys[slot] == own[at]
        at, slot = at[true], slot[true]
        counts = self.first[slot + 1] - self.first[slot]
        if not len(at):
            return []
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        entry = np.repeat(self.first[slot], counts) + inside
        item = self.owner[entry].astype(np.int64)
        diagonal = np.repeat(at, counts).astype(np.int64) - self.place[entry]
        # Bands as wide as twice the budget plus one, each begun half a band after the one before: any
        # group of diagonals within the budget of each other lies inside one of them.
        half = self.halves[item]
        span = len(folded) + 2 * reach
        band = (diagonal + reach) // half
        width = span + 2
        keys = np.concatenate([item * width + band, item * width + band - (band > 0)])
        # A gram found twice on one offset pair counts once per band; the lemma counts offsets of the item.
        found, hits = np.unique(keys, return_counts=True)
        passed = found[hits >= self.bounds[found // width]]
        out = []
        for key in passed.tolist():
            k, b = divmod(key, width)
            size = self.items[k].budget + 1
            out.append((k, b * size - reach, (b + 2) * size - 1 - reach))
        return out

    def search(self, text: bytes) -> list[tuple[int | None, int, int, int]]:
        """(item_id, start, end, edits) of every item found: its best occurrence, in code points."""
        folded, begins, ends = normalised(text)
        if not len(folded):
            return []
        best: dict[int, tuple[int, int, int]] = {}
        for k, low, high in self.candidates(folded):
            item = self.items[k]
            hit = align(item.text, folded, low, high, item.budget)
            if hit and (k not in best or hit < best[k]):
                best[k] = hit
        found = [(self.items[k], *hit) for k, hit in best.items()]
        if self.short:
            whole = " " + as_text(folded).strip(" ") + " "
            lead = 1 if folded[0] == 32 else 0
            for item in self.short:
                place = whole_word(item.text, whole)
                if place >= 0:
                    place += lead - 1
                    found.append((item, 0, place, place + len(item.text)))
        out = [
            (item.item_id, int(begins[start]), int(ends[end - 1]), edits) for item, edits, start, end in found
        ]
        return sorted(out, key=lambda row: (row[0] is None, row[0] or 0, row[1]))


def _last_row(item: np.ndarray, text: np.ndarray, low: int, width: int, anchored: bool = False) -> np.ndarray:
    """Edit distances of the whole item to stretches of text that end on each diagonal of the band.

    The stretch may begin anywhere, or, if ``anchored``, at the beginning of the text.
    """
    offsets = np.arange(width)
    far = 2 * len(item) + width
    row = np.abs(offsets + low) if anchored else np.zeros(width, np.int64)
    row[(offsets + low < 0) | (offsets + low > len(text))] = far
    for i, letter in enumerate(item):
        column = offsets + low + i  # of the text, read by this step
        real = (column >= 0) & (column < len(text))
        step = row + (text[np.clip(column, 0, len(text) - 1)] != letter)
        step[~real] = far
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        step = np.minimum.accumulate(step - offsets) + offsets
        row = np.minimum(step, far)
        row[(column + 1 < 0) | (column + 1 > len(text))] = far
    return row


def align(item: str, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best alignment that starts and stays near the band, within the budget."""
    m = len(item)
    low, high = low - budget, high + budget
    begin, end = max(0, low), min(len(text), high + m + 1)
    region = text[begin:end]
    exact = as_text(region).find(item)
    if exact >= 0:
        return 0, begin + exact, begin + exact + m
    letters = letters_of(item)
    row = _last_row(letters, text, low, high - low + 1)
    edits = int(row.min())
    if edits > budget:
        return None
    stop = low + int(row.argmin()) + m
    # Backwards from the end, to find the start.
    tail = text[max(0, stop - m - budget) : stop][::-1]
    back = _last_row(letters[::-1], tail, -budget, 2 * budget + 1, anchored=True)
    lengths = np.arange(2 * budget + 1) - budget + m
    size = int(min(lengths[back == back.min()], key=lambda length: abs(length - m)))
    return edits, max(0, stop - size), stop


def item_parts(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The different texts of the benchmark and their hashes, in parts of about PART_BYTES bytes."""
    texts = only(benchmark, "text").filter("text is not null").distinct().select(F.xxhash64("text").alias("key"), "text")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_parts = -(-size // PART_BYTES)
    for part in range(n_parts):
        chosen = texts.filter(F.pmod("key", F.lit(n_parts)) == part)
        yield [(r["key"], r["text"]) for r in chosen.collect()]


def _hits_of(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in pieces(batch):
                    ids = part.column("doc_id").to_pylist()
                    rows = [
                        (doc_id, *hit)
                        for doc_id, text in zip(ids, as_bytes(part), strict=True)
                        for hit in index.search(text)
                    ]
                    if rows:
                        yield arrow_rows(HITS, zip(*rows, strict=True))

    return run


def _clean_of(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        with np.errstate(over="ignore"):
            for batch in batches:
                for part in pieces(batch):
                    yield part.filter(pa.array([not index.search(text) for text in as_bytes(part)], pa.bool_()))

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: ``doc_id``, ``item_id``, span of the best occurrence
    (code points, end exclusive) and its edits."""
    spark = docs.sparkSession
    docs = only(docs, "doc_id", "text")
    hits = spark.createDataFrame([], HITS_DDL)
    for items in item_parts(benchmark):
        shared = spark.sparkContext.broadcast(ItemIndex(items))
        hits = hits.unionByName(on_batches(docs, _hits_of(shared), HITS_DDL))
    rows = benchmark.filter("text is not null").select(F.xxhash64("text").alias("key"), F.col("item_id").cast("bigint"))
    return (
        hits.withColumnRenamed("item_id", "key")
        .join(rows, "key")
        .select("doc_id", "item_id", "span_start", "span_end", "edits")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are."""
    for items in item_parts(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(items))
        docs = on_batches(docs, _clean_of(shared), docs.schema)
    return docs

"""Token counts by a two-tier look-up of pre-tokens, without shuffling pre-tokens.

The tokenizer's model joins no piece across the blank before a word, so a text's tokens are the sum over its
pre-tokens: each run of blanks with the word after it. Tier one is a table of the lengths of the FREQUENT
commonest pre-tokens, broadcast; it is found from one bounded summary per partition, and its entries never
change a result, only how often tier two is asked. Tier two encodes what the table lacks and remembers up to
CACHED lengths in the worker. A model that could join pieces across blanks, or that drops blanks, is found
out when it is loaded; whole texts are encoded then.

Defined results: null and empty texts have no bytes and no tokens. Rows are counted alone, and repeated rows
give repeated counts. Special strings in texts are ordinary text. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, on_batches, only, pieces

FREQUENT = 50_000
# A partition's summary: the entries it may hold while counting, and those it hands on.
SUMMARY_HELD = 200_000
SUMMARY_SENT = 20_000
CACHED = 300_000
LIMIT = 4096

BLANK = "▁"  # fixed value: the sign that stands for a blank in the pieces
_UNITS = re.compile(r"( +[^ ]*)")
PROBES = ("", " ", "a", " a  b ", "x\n\ny z", "  ﬁ 　.", "</s> <unk> a", "a\tb\r\n  c")

COUNTED = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
)
COUNTED_DDL = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens without their first blank (the tokenizer puts one before the text itself)."""
    if BLANK in text:
        text = text.replace(BLANK, " ")
    if "  " not in text and text[:1] != " " != text[-1:]:
        return text.split(" ") if text else []
    return [unit[1:] for unit in _UNITS.findall(" " + text)]


class Lengths(dict):
    """Length in tokens of each pre-token; encodes what it lacks."""

    def __init__(self, model: bytes, table: dict[str, int]):
        super().__init__(table)
        self.table = table
        self.tokenizer = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.tokenizer.vocab_size()
        joins = any(
            re.search(f"[^{BLANK}]{BLANK}", self.tokenizer.id_to_piece(i)) for i in range(size)
        )
        self.splits = not joins and all(
            self._by_units(p) == len(self.tokenizer.encode(p)) for p in PROBES
        )

    def __missing__(self, unit: str) -> int:
        if len(self) > len(self.table) + CACHED:
            self.clear()
            self.update(self.table)
        length = self[unit] = len(self.tokenizer.encode(unit)) if unit else 1
        return length

    def _by_units(self, text: str) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))

    def of(self, text: str) -> int:
        return self._by_units(text) if self.splits else len(self.tokenizer.encode(text))


# What a worker process last unpacked from a broadcast, and the lengths it knows: they outlive a task.
_LATEST: list = [None, None]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for part in pieces(batch, 500):
            for text in part.column("text").to_pylist():
                if text:
                    counts.update(pre_tokens(text))
            if len(counts) > SUMMARY_HELD:
                counts = Counter(dict(counts.most_common(SUMMARY_HELD // 2)))
    top = counts.most_common(SUMMARY_SENT)
    if top:
        yield arrow_rows(pa.schema([("unit", pa.string()), ("n", pa.int64())]), zip(*top, strict=True))


def frequent_pre_tokens(docs: DataFrame, most: int = FREQUENT) -> list[str]:
    found = on_batches(only(docs, "text"), _summaries, "unit string, n bigint")
    top = found.groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(most)
    return [row["unit"] for row in top.collect()]


def _counting(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _LATEST[0] is not shared.value:
            _LATEST[:] = [shared.value, Lengths(*shared.value)]
        lengths = _LATEST[1]
        for batch in batches:
            for part in pieces(batch, 500):
                texts = [text or "" for text in part.column("text").to_pylist()]
                counts = [lengths.of(text) for text in texts]
                yield arrow_rows(
                    COUNTED,
                    [
                        part.column("doc_id"),
                        [len(text) if text.isascii() else len(text.encode()) for text in texts],
                        counts,
                        [n > LIMIT for n in counts],
                    ],
                )

    return run


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of each row, by the model in ``model_path``."""
    docs = only(docs, "doc_id", "text")
    with open(model_path, "rb") as file:
        model = file.read()
    lengths = Lengths(model, {})
    table = {unit: lengths[unit] for unit in frequent_pre_tokens(docs)} if lengths.splits else {}
    shared = docs.sparkSession.sparkContext.broadcast((model, table))
    return on_batches(docs, _counting(shared), COUNTED_DDL)

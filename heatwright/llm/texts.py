"""Shared helpers of the text operators: reading tables, staging results, words of a text, stable hashes."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwright.session import scratch_path

# A word is a run of characters other than blank, tab, newline, vertical tab, form feed and return. The
# bytes method split() without argument cuts at exactly these six.
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def on_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path (local sessions started elsewhere)."""
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, _ROOT]))
    return df.mapInArrow(function, schema)


def as_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 of a text column; null counts as empty."""
    values = batch.column(name).cast(pa.binary()).to_pylist()
    return [value or b"" for value in values]


def pieces(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Short slices of a batch, so that what is worked out for its rows stays small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def arrow_rows(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c, pa.Array) else pa.array(c, field.type)
            for c, field in zip(columns, schema, strict=True)
        ],
        schema=schema,
    )


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (finaliser of a multiplicative generator)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def code_points(data: bytes) -> int:
    """Characters of valid UTF-8: every byte that does not continue one."""
    if data.isascii():
        return len(data)
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that further columns can't clash with those made here."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Elements of an array that are gone through at once.
RUN = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each element what ``step`` makes of those before it.

    A list that grows is copied at each step, so elements are taken in runs: the work is RUN copies an element.
    """

    def listed(items: Column, start: Column, of: Callable[[Column], Column]) -> Column:
        empty = F.array_repeat(zero, 0)
        return F.aggregate(
            items,
            F.struct(start.alias("now"), empty.alias("done")),
            lambda state, x: F.struct(
                step(state["now"], of(x)).alias("now"), F.array_append(state["done"], state["now"]).alias("done")
            ),
            lambda state: state["done"],
        )

    def in_runs(all_values: Column) -> Column:
        runs = F.ceil(F.size(all_values) / RUN).cast("int")
        cut = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.slice(all_values, i * RUN + 1, F.lit(RUN)))

        def with_starts(chunks: Column) -> Column:
            totals = F.transform(chunks, lambda c: F.aggregate(c, zero, step))
            starts = listed(totals, zero, lambda x: x)
            return F.flatten(F.zip_with(chunks, starts, lambda c, start: listed(c, start, lambda x: x)))

        return F.when(F.size(all_values) == 0, F.array_repeat(zero, 0)).otherwise(bound(cut, with_starts))

    return bound(values, in_runs)

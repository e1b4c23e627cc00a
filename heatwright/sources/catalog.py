"""Source registry: logical table name -> DataFrame with the declared schema.

A catalog may mix back ends (two databases, files, frames), so one plan can join across them.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwright.functions.scalars import matches, strip_sql
from heatwright.sources.schemas import CLUSTERED_BY, HEAT_ID_COLUMNS, SOURCES

# Words of the bitmap that filters by a relation: 128 KiB. Full from some millions of heats on, it lets all through.
BITMAP_WORDS = 1 << 14
# Rows of the largest table that share a bucket: a bucket is one task, however large the tables are.
ROWS_PER_BUCKET = 250_000
LEAST_BUCKETS = 8


@dataclass(frozen=True)
class Near:
    """A relation of heats as a filter that lets some others pass: enough for a lookup that is joined to exact heats."""

    heats: DataFrame
    summary: DataFrame | None = None


@dataclass(frozen=True)
class Chosen:
    """A relation of heats with its ``heat_summary``, computed once for several queries."""

    heats: DataFrame
    summary: DataFrame


HeatFilter = DataFrame | Chosen | Near | str | Collection[str] | None


class SchemaMismatch(ValueError):
    """A source does not carry the declared columns, or carries them with another kind of value."""


@dataclass(frozen=True)
class JdbcTable:
    """Where a table lives in a database and how to split its scan over tasks."""

    table: str
    column: str | None = None
    lower: object = None
    upper: object = None
    partitions: int | None = None

    def options(self, url: str, properties: Mapping[str, str]) -> dict[str, str]:
        options = {"url": url, "dbtable": self.table, "preferTimestampNTZ": "true", **properties}
        if self.column is not None:
            options |= {
                "partitionColumn": self.column,
                "lowerBound": str(self.lower),
                "upperBound": str(self.upper),
                "numPartitions": str(self.partitions),
            }
        return options


def _fits(found: T.DataType, wanted: T.DataType) -> bool:
    if isinstance(wanted, T.StringType):
        return isinstance(found, (T.StringType, T.CharType, T.VarcharType))
    if isinstance(wanted, T.TimestampNTZType):
        return isinstance(found, (T.TimestampNTZType, T.TimestampType, T.DateType))
    if isinstance(wanted, T.DoubleType):
        return isinstance(found, T.NumericType)
    # Databases report whole numbers as decimals.
    return isinstance(found, (T.IntegralType, T.DecimalType))


def conform(
    df: DataFrame, schema: T.StructType, name: str = "source", padded: bool = False
) -> DataFrame:
    """Lower-case the names, check columns and types, cast, and strip padded heat identifiers.

    A stripped column cannot be filtered at the scan, so only tables that need it are stripped.
    """
    if any(column != column.lower() for column in df.columns):
        df = df.toDF(*[column.lower() for column in df.columns])
    found = {field.name: field.dataType for field in df.schema.fields}
    problems = [
        f"{field.name}: {found[field.name].simpleString() if field.name in found else 'missing'}, "
        f"declared {field.dataType.simpleString()}"
        for field in schema.fields
        if field.name not in found or not _fits(found[field.name], field.dataType)
    ]
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    columns = []
    for field in schema.fields:
        column = f"`{field.name}`"
        if found[field.name] != field.dataType:
            column = f"CAST({column} AS {field.dataType.simpleString()})"
        if padded and field.name in HEAT_ID_COLUMNS:
            column = strip_sql(column)
        columns.append(f"{column} AS `{field.name}`")
    return df.selectExpr(*columns)


class SourceCatalog:
    """Logical names to DataFrames; a table is resolved on first use.

    ``padded`` names the tables whose heat identifiers may carry blanks around them (fixed-width
    columns of a database). They are stripped at load. The identifiers of all other tables are taken
    as they are, so that a heat filter reaches their scan.
    """

    def __init__(
        self,
        loaders: Mapping[str, Callable[[], DataFrame]],
        schemas: Mapping[str, T.StructType] = SOURCES,
        padded: Collection[str] = (),
    ):
        self._padded = frozenset(padded)
        self._loaders = dict(loaders)
        self._schemas = schemas
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_frames(
        cls, frames: Mapping[str, DataFrame], padded: Collection[str] = ()
    ) -> SourceCatalog:
        return cls({name: (lambda df=df: df) for name, df in frames.items()}, padded=padded)

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        root: str,
        tables: Iterable[str] = tuple(SOURCES),
        padded: Collection[str] = (),
    ) -> SourceCatalog:
        """One folder (or file) ``<root>/<table>.parquet`` per table."""
        return cls(
            {name: (lambda name=name: spark.read.parquet(f"{root}/{name}.parquet")) for name in tables},
            padded=padded,
        )

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        tables: Mapping[str, JdbcTable],
        properties: Mapping[str, str] | None = None,
        padded: Collection[str] = (),
    ) -> SourceCatalog:
        """Tables of one database, each scan split on its own column."""

        def load(table: JdbcTable) -> DataFrame:
            return spark.read.format("jdbc").options(**table.options(url, properties or {})).load()

        loaders = {name: (lambda table=table: load(table)) for name, table in tables.items()}
        return cls(loaders, padded=padded)

    @classmethod
    def from_tables(
        cls, spark: SparkSession, prefix: str, tables: Iterable[str] = tuple(SOURCES), padded: Collection[str] = ()
    ) -> SourceCatalog:
        """Tables ``<prefix><table>`` of the session's catalog, such as ``store_bucketed`` makes."""
        return cls({name: (lambda name=name: spark.table(f"{prefix}{name}")) for name in tables}, padded=padded)

    def store_bucketed(
        self,
        prefix: str,
        root: str,
        buckets: int,
        clustered_by: Mapping[str, str] = CLUSTERED_BY,
    ) -> SourceCatalog:
        """A catalog whose tables are stored under ``root`` in ``buckets`` by the key they are joined on, and sorted by it.

        Tables of one key then meet bucket by bucket: their joins and groupings need no exchange, and their sort is
        there already. Stored once, read by every report. Tables that are not named in ``clustered_by`` stay as they are.
        """
        stored = {}
        for name, key in clustered_by.items():
            if name not in self:
                continue
            rows = self[name]
            spark, full = rows.sparkSession, f"{prefix}{name}"
            placed = rows.repartition(buckets, key).sortWithinPartitions(key)
            writer = placed.write.format("parquet").bucketBy(buckets, key).sortBy(key).mode("overwrite")
            writer.option("path", f"{root}/{name}").saveAsTable(full)
            stored[name] = lambda full=full, spark=spark: spark.table(full)
        return self.merged(SourceCatalog(stored, self._schemas))

    def merged(self, other: SourceCatalog) -> SourceCatalog:
        """Both catalogs in one; names of ``other`` win."""
        padded = (self._padded - set(other._loaders)) | other._padded
        return SourceCatalog(
            {**self._loaders, **other._loaders}, {**self._schemas, **other._schemas}, padded
        )

    def __contains__(self, name: str) -> bool:
        return name in self._loaders

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._loaders:
                raise KeyError(f"no source registered for table {name!r}")
            df = self._loaders[name]()
            schema = self._schemas.get(name)
            self._frames[name] = df if schema is None else conform(df, schema, name, name in self._padded)
        return self._frames[name]


def buckets_for(rows: int) -> int:
    """Buckets for tables of which the largest has so many rows."""
    return max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET))


def inline_rows(spark: SparkSession, schema: T.StructType, rows: Sequence[tuple]) -> DataFrame:
    """A relation of literal rows, as a merge source or a small lookup."""
    return spark.createDataFrame(list(rows), schema)


def heat_list(spark: SparkSession, heats: Iterable[object]) -> DataFrame:
    """The requested heats as a relation with one column ``heat_id``; Spark knows its size."""
    schema = T.StructType([T.StructField("heat_id", T.StringType())])
    return inline_rows(spark, schema, [(heat,) for heat in heat_ids(heats)])


def heat_ids(heats: Iterable[object]) -> list[str]:
    return sorted({str(heat).strip() for heat in heats})


def only_heats(df: DataFrame, heats: HeatFilter, column: str) -> DataFrame:
    """Keep the rows of the requested heats: all, a LIKE pattern, a list, or a relation with ``heat_id``.

    A pattern or a list becomes a filter that reaches the scan. A relation is semi-joined; Spark sends
    it to the executors when it is known to be small. Before that, and before any shuffle, rows are
    filtered at the scan by the relation's range and bitmap, found at run time; ``Near`` leaves it at that.
    """
    if heats is None:
        return df
    if isinstance(heats, str):
        return df.where(matches(F.col(column), heats))
    if isinstance(heats, Near):
        summary = heat_summary(heats.heats) if heats.summary is None else heats.summary
        return df.where(_passes(summary, F.col(column)))
    if not isinstance(heats, DataFrame | Chosen):
        return df.where(F.col(column).isin(heat_ids(heats)))
    relation = heats.heats if isinstance(heats, Chosen) else heats
    near = only_heats(df, near_heats(heats), column)
    return near.join(relation.select(F.col("heat_id").alias(column)), column, "left_semi")


def near_heats(heats: HeatFilter) -> HeatFilter:
    """The filter of lookups whose heats are left joined to: a relation need not be semi-joined for each of them."""
    if isinstance(heats, Chosen):
        return Near(heats.heats, heats.summary)
    return Near(heats) if isinstance(heats, DataFrame) else heats


def may_be_among(relation: DataFrame, name: str, value: Column) -> Column:
    """Whether ``value`` lies between the least and the greatest of a relation's values and its hash is in their bitmap.

    Both come from one scalar subquery, an aggregate of fixed size however large the relation is: all of a plan's
    sources share it. What is not in the relation may pass by chance, so an exact join must follow.
    """
    return _passes(heat_summary(relation, name), value)


def heat_summary(relation: DataFrame, name: str = "heat_id") -> DataFrame:
    """One row: the ``low``est and ``high``est of a relation's values, and the ``bits`` of their hashes."""
    held = relation.select(F.col(name).alias("v")).where(F.col(name).isNotNull())
    place = F.pmod(F.xxhash64("v"), F.lit(64 * BITMAP_WORDS))
    words = held.groupBy(F.floor(place / 64).alias("word")).agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))).alias("bits"),
    )
    every = relation.sparkSession.range(0, BITMAP_WORDS, 1, 1).select(F.col("id").alias("word")).join(words, "word", "left")
    in_order = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return every.agg(F.min("low").alias("low"), F.max("high").alias("high"), in_order["bits"].alias("bits"))


def _passes(summary: DataFrame, value: Column) -> Column:
    found = summary.select(F.struct("low", "high", "bits")).scalar()
    mine = F.pmod(F.xxhash64(value), F.lit(64 * BITMAP_WORDS))
    bits = F.get(found["bits"], F.floor(mine / 64).cast("int"))
    hit = F.call_function("shiftrightunsigned", bits, (mine % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return (value >= found["low"]) & (value <= found["high"]) & hit

"""Left lookup with defaults for keys that have no row, and joins that stay whole under skew."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatwright.functions.scalars import sql_text


def spread_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """Add ``name``: the text key, or for a null key a filler that matches nothing.

    Rows without a key would all hash to one partition of a left join. The filler starts with a
    control character, which no key does, and varies with the row.
    """
    filler = F.concat(F.lit("\x01"), F.xxhash64(*df.columns).cast("string"))
    return df.withColumn(name, F.coalesce(F.col(key), filler))


def enrich(
    report: DataFrame,
    lookup: DataFrame,
    key: str,
    columns: Mapping[str, str],
    defaults: Mapping[str, object] | None = None,
    lookup_key: str | None = None,
    present_key: str | None = None,
) -> DataFrame:
    """Add columns of ``lookup`` (at most one row per key) to every report row of the same key.

    ``columns`` maps lookup names to report names. A default, named by report column, is used only
    where the lookup has no row: a row holding null stays null. A report row without a key gets null;
    ``present_key`` names the column that tells, when ``key`` is a filled-up copy of it.
    """
    lookup_key = lookup_key or key
    found = lookup.selectExpr("*", "true AS _found").alias("_lookup")
    joined = report.alias("_report").join(
        found, F.col(f"_report.`{key}`") == F.col(f"_lookup.`{lookup_key}`"), "left"
    )
    added = []
    for source, target in columns.items():
        value = f"_lookup.`{source}`"
        default = (defaults or {}).get(target)
        if default is not None:
            kind = lookup.schema[source].dataType.simpleString()
            value = (
                f"CASE WHEN _found THEN {value} "
                f"WHEN _report.`{present_key or key}` IS NOT NULL THEN CAST({sql_text(default)} AS {kind}) END"
            )
        added.append(f"{value} AS `{target}`")
    return joined.selectExpr("_report.*", *added)


# A key is hot if it has at least HOT_ROWS rows and one in HOT_PARTS of its table's; it is dealt to as many salts as it
# has such parts. No more than HOT_PARTS keys can be.
HOT_ROWS = 100_000
HOT_PARTS = 64


def _key_text(keys: Sequence[str]) -> Column:
    """The keys as one text; no two keys share it, and it is null where one of them is."""
    parts = [F.concat(F.length(F.col(key).cast("string")).cast("string"), F.lit(":"), F.col(key).cast("string")) for key in keys]
    return F.concat(*parts)


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS, parts: int = HOT_PARTS) -> Column:
    """Salts by the text of each hot key, as a scalar subquery: a frequency sketch over the key columns alone."""
    sketch = df.select(_key_text(keys).alias("_key")).agg(
        F.count("_key").alias("n"), F.expr(f"approx_top_k(_key, {parts}, {64 * parts})").alias("top")
    )
    most = F.greatest(F.lit(rows), F.col("n") / parts)
    hot = F.filter("top", lambda x: x["item"].isNotNull() & (x["count"] >= most))
    salts = F.transform(
        hot,
        lambda x: F.struct(x["item"], F.greatest(F.lit(2), F.least(F.lit(parts), F.ceil(x["count"] * parts / F.col("n")))).cast("int")),
    )
    return sketch.select(F.map_from_entries(salts)).scalar()


def left_join_spread(
    left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS, parts: int = HOT_PARTS
) -> DataFrame:
    """Left outer join that stays whole when a key has very many rows on either side, or on both.

    Adaptive execution can split a hot key of an outer join on its preserved side only. Here the rows of a hot key are
    dealt to a grid: a left row to one of the key's left salts and to all its right salts, a right row the other way
    round, so every pair meets in one cell. A key hot on the right has right rows; its left rows that meet none in a
    cell are dropped there. Each table is read once, besides the sketch of its keys. Rows with a null key match nothing
    and are dealt to everywhere. Rows alike in every column go to one salt.
    """
    left_salts, right_salts = hot_keys(left, keys, rows, parts), hot_keys(right, keys, rows, parts)

    def dealt(df: DataFrame, own: Column, other: Column, mine: str, theirs: str, spread_null: bool) -> DataFrame:
        place = F.xxhash64(*df.columns)
        salt = F.pmod(place, F.coalesce(F.try_element_at(own, F.col("_key")), F.lit(1)).cast("bigint"))
        many = F.coalesce(F.try_element_at(other, F.col("_key")), F.lit(1))
        keyed = df.withColumn("_key", _key_text(keys))
        if spread_null:
            salt = F.when(F.col("_key").isNull(), place).otherwise(salt)
        return keyed.withColumns({mine: salt, "_many": many}).withColumn(
            theirs, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_many").cast("bigint") - 1))
        )

    mine = dealt(left, left_salts, right_salts, "_row", "_column", True).drop("_key")
    theirs = dealt(right.where(_key_text(keys).isNotNull()), right_salts, left_salts, "_column", "_row", False)
    theirs = theirs.drop("_key", "_many").withColumn("_met", F.lit(True))
    joined = mine.join(theirs, [*keys, "_row", "_column"], "left")
    joined = joined.where(F.col("_met").isNotNull() | (F.col("_many") == 1))
    return joined.drop("_row", "_column", "_many", "_met")

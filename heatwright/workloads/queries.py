"""Every report operator as a query over the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatwright.functions.scalars import (
    event_text,
    free_open_text,
    lenient_bigint,
    matches,
    seconds_between,
    zero_to_null,
)
from heatwright.operators.keyed import delete_by_key, merge_upsert, replace_by_key
from heatwright.operators.latest import latest_non_null, newest_per_key, top_n_per_key
from heatwright.operators.lookups import enrich
from heatwright.operators.pivots import pivot_vocabulary, unlisted
from heatwright.operators.quality import repeated_keys, split_valid
from heatwright.plans.additions import additions_by_heat, additions_detail
from heatwright.plans.chemistry import chemistry, element_values, latest_chemistry
from heatwright.plans.heat_report import heat_report
from heatwright.plans.heat_sheet import energy_per_heat, heat_sheet, primary_recipes
from heatwright.plans.incremental import run_incremental
from heatwright.plans.measurements import OXYGEN, TEMPERATURE, latest_measurement
from heatwright.plans.milestones import stir_ladle_times
from heatwright.plans.reference_report import last_heats, ref_report
from heatwright.plans.run import run_report
from heatwright.session import prepare, scratch_path
from heatwright.sinks.report_table import ReportTable, read_csv, write_csv
from heatwright.sources.catalog import SourceCatalog, buckets_for, inline_rows, only_heats
from heatwright.sources.schemas import ADDITIONS, ELEMENTS, REPORT
from heatwright.workloads.plant_views import customer_plant, order_plant, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

UPSERT_FROM = "2024-01-20 00:00:00"
TARGET_COLUMNS = ["user_id", "event_type", "event_id", "value", "ts"]
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_shipdate",
]


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepare(spark), sf_dir)

    QUERIES[build.__name__] = run
    return run


def _lower(df: DataFrame) -> DataFrame:
    """Column names as plain SQL identifiers."""
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


# Event milestones -------------------------------------------------------------------------------


@query
def event_milestones(spark, sf_dir):
    return _lower(stir_ladle_times(order_plant(spark, sf_dir)))


@query
def event_milestones_newest(spark, sf_dir):
    return _lower(stir_ladle_times(order_plant(spark, sf_dir), newest_first=True))


@query
def event_milestones_corrected(spark, sf_dir):
    return _lower(stir_ladle_times(order_plant(spark, sf_dir), times="corrected"))


# Measurements -----------------------------------------------------------------------------------


@query
def latest_measurement_oxygen(spark, sf_dir):
    return latest_measurement(order_plant(spark, sf_dir), **OXYGEN)


@query
def latest_measurement_temperature(spark, sf_dir):
    return latest_measurement(order_plant(spark, sf_dir), **TEMPERATURE)


@query
def newest_event(spark, sf_dir):
    """Newest event per user whose type holds an r."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").like("%r%"))
    newest = newest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.select("user_id", "event_id", "ts", "event_type", "value")


# Chemistry --------------------------------------------------------------------------------------


@query
def chemistry_rows(spark, sf_dir):
    """Two newest rows per heat, so that the cap bites."""
    return chemistry(order_plant(spark, sf_dir), limit=2)


@query
def chemistry_all(spark, sf_dir):
    """The newest rows of the whole plant."""
    return chemistry(order_plant(spark, sf_dir), scope="all", limit=5000)


@query
def chemistry_unlimited(spark, sf_dir):
    return chemistry(order_plant(spark, sf_dir))


@query
def newest_lines_per_supplier(spark, sf_dir):
    """A large cap per key."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", *[c for c in LINE_ORDER if c != "l_suppkey"])
    order = [F.col("l_shipdate").desc()] + [F.col(c).desc() for c in LINE_ORDER if c != "l_shipdate"]
    return top_n_per_key(lines, ["l_suppkey"], order, 150)


@query
def latest_element(spark, sf_dir):
    return latest_chemistry(element_values(order_plant(spark, sf_dir)))


@query
def latest_value(spark, sf_dir):
    """Newest discount and tax, each on its own, that is not zero per supplier and part type."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = table(spark, sf_dir, "lineitem").join(part, "l_partkey")
    lines = lines.withColumns(
        {"discount": zero_to_null(F.col("l_discount")), "tax": zero_to_null(F.col("l_tax"))}
    )
    order = ["l_shipdate", *[c for c in LINE_ORDER if c != "l_shipdate"]]
    return latest_non_null(lines, ["l_suppkey", "p_type"], ["discount", "tax"], order)


@query
def element_pivot(spark, sf_dir):
    latest = latest_chemistry(element_values(order_plant(spark, sf_dir)))
    wide = pivot_vocabulary(
        latest, "heat_id", "elem_name", {"elem_value": "TOTAL_"}, ELEMENTS, ["elem_type"]
    )
    return _lower(wide)


# Additions --------------------------------------------------------------------------------------


@query
def additions_by_heat_reference(spark, sf_dir):
    return additions_by_heat(customer_plant(spark, sf_dir))


@query
def additions_by_heat_corrected(spark, sf_dir):
    return additions_by_heat(customer_plant(spark, sf_dir), fanout="corrected")


@query
def additions_by_heat_first(spark, sf_dir):
    return additions_by_heat(customer_plant(spark, sf_dir), limit=1000)


@query
def addition_pivot(spark, sf_dir):
    wide = pivot_vocabulary(
        additions_by_heat(customer_plant(spark, sf_dir)),
        "heat_id",
        "material_id",
        {"weight_act": "WEIGHT_", "length_act": "LENGTH_"},
        ADDITIONS,
        ["area_id"],
    )
    return _lower(wide)


@query
def unlisted_materials(spark, sf_dir):
    materials = order_plant(spark, sf_dir)["l2_l3_heat_addition_material"]
    return unlisted(materials, "material_id", ADDITIONS)


@query
def unlisted_elements(spark, sf_dir):
    return unlisted(latest_chemistry(element_values(order_plant(spark, sf_dir))), "elem_name", ELEMENTS)


@query
def additions_detail_list(spark, sf_dir):
    return additions_detail(order_plant(spark, sf_dir), limit=3000)


@query
def additions_detail_unlimited(spark, sf_dir):
    return additions_detail(order_plant(spark, sf_dir))


# Heat sheet -------------------------------------------------------------------------------------


def _energy(spark, sf_dir, mode):
    src = order_plant(spark, sf_dir)
    return energy_per_heat(src["melt_heat_consumption"], src["melt_heat_result"], mode)


@query
def energy_fanout(spark, sf_dir):
    return _energy(spark, sf_dir, "reference")


@query
def energy_sum(spark, sf_dir):
    return _energy(spark, sf_dir, "corrected")


@query
def primary_route(spark, sf_dir):
    return primary_recipes(order_plant(spark, sf_dir))


@query
def heat_sheet_reference(spark, sf_dir):
    return _lower(heat_sheet(order_plant(spark, sf_dir)))


@query
def heat_sheet_corrected(spark, sf_dir):
    return _lower(heat_sheet(order_plant(spark, sf_dir), energy="corrected"))


@query
def heat_sheet_selected(spark, sf_dir):
    """Heats chosen by a relation: all that the caster reported."""
    src = order_plant(spark, sf_dir)
    return _lower(heat_sheet(src, heats=src["l2_l3_heat_report_ccm"].select("heat_id")))


@query
def heat_sheet_padded(spark, sf_dir):
    """Sources with upper-case names and blanks around the heat ids."""
    src = order_plant(spark, sf_dir)
    heats = ["melt_heat", "melt_heat_result", "melt_heat_consumption"]
    padded = {}
    for name in heats:
        frame = src[name].withColumn("mlh_heat_no", F.concat(F.lit(" "), "mlh_heat_no", F.lit("\t ")))
        padded[name] = frame.toDF(*[column.upper() for column in frame.columns])
    return _lower(heat_sheet(src.merged(SourceCatalog.from_frames(padded, padded=heats))))


@query
def repeated_heats(spark, sf_dir):
    """Lab samples that carry more than one row for a heat."""
    return repeated_keys(order_plant(spark, sf_dir)["l2_l3_chem_result"], ["heat_id", "area_id"])


# Reference report and heat list -----------------------------------------------------------------


@query
def ref_report_newest(spark, sf_dir):
    return ref_report(order_plant(spark, sf_dir), limit=50)


REF_SINCE = {"since": "1995-06-17 00:00:00", "min_heat": 1100000500}


@query
def ref_report_since(spark, sf_dir):
    return ref_report(order_plant(spark, sf_dir), **REF_SINCE, limit=50)


@query
def ref_report_since_unlimited(spark, sf_dir):
    return ref_report(order_plant(spark, sf_dir), **REF_SINCE)


@query
def ref_report_heats(spark, sf_dir):
    """Reports of the heats that a relation names."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    heats = customers.select((F.col("c_custkey") + 1100000000).cast("string").alias("heat_id"))
    return ref_report(order_plant(spark, sf_dir), heats)


@query
def ref_report_unlimited(spark, sf_dir):
    return ref_report(order_plant(spark, sf_dir))


@query
def last_heats_list(spark, sf_dir):
    return last_heats(order_plant(spark, sf_dir), 25)


# Lookups, functions, filters, set operation -----------------------------------------------------


@query
def lookup_defaults(spark, sf_dir):
    """Newest line of every order; orders without a line get the defaults."""
    lines = table(spark, sf_dir, "lineitem")
    order = [F.col("l_shipdate").desc()] + [F.col(c).desc() for c in LINE_ORDER if c != "l_shipdate"]
    newest = newest_per_key(lines, ["l_orderkey"], order)
    newest = newest.withColumn("discount", zero_to_null(F.col("l_discount")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return enrich(
        orders,
        newest,
        "o_orderkey",
        {
            "l_quantity": "last_quantity",
            "discount": "last_discount",
            "l_returnflag": "last_flag",
            "l_shipdate": "last_time",
        },
        {"last_quantity": 0, "last_discount": 0, "last_flag": "---"},
        lookup_key="l_orderkey",
    )


@query
def safe_number(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        lenient_bigint(F.substring("p_brand", 7, 4)).alias("brand_no"),
        lenient_bigint(F.col("p_type")).alias("type_no"),
        lenient_bigint(F.concat(F.lit(" "), F.col("p_retailprice").cast("string"), F.lit(" "))).alias(
            "price_no"
        ),
        lenient_bigint(F.concat(F.col("p_partkey").cast("string"), F.lit("D"))).alias("suffixed_no"),
        lenient_bigint(F.concat(F.lit("0x"), F.col("p_partkey").cast("string"), F.lit("p1"))).alias("hex_no"),
    )


@query
def scalar_functions(spark, sf_dir):
    """Text times, durations, flags, zero to null and units over every line with its order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderstatus"
    )
    lines = table(spark, sf_dir, "lineitem").join(orders, "l_orderkey")
    return lines.select(
        *LINE_ORDER[:4],
        event_text(F.col("l_shipdate")).alias("ship_text"),
        seconds_between(F.col("o_orderdate"), F.col("l_shipdate")).alias("wait_seconds"),
        free_open_text(F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O", "1")).alias(
            "free_open"
        ),
        F.round(F.col("l_quantity") / zero_to_null((F.col("l_linenumber") - 1).cast("double")), 4).alias(
            "ratio"
        ),
    )


@query
def event_seconds(spark, sf_dir):
    """Durations with fractions of a second."""
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    return table(spark, sf_dir, "events").select(
        "event_id", seconds_between(start, F.col("ts")).alias("seconds")
    )


@query
def like_filters(spark, sf_dir):
    """Contains, prefix and list filters as the reports select by them."""
    part = table(spark, sf_dir, "part").where(F.col("p_brand").isNotNull())
    named = only_heats(only_heats(part, "%ring%", "p_name"), "S%", "p_type")
    events = table(spark, sf_dir, "events").where(
        (F.col("ts") > F.lit("2024-01-10 06:00:00").cast("timestamp_ntz")) & (F.col("value") > 1.5)
    )
    typed = only_heats(events, ["click", "view", "signup"], "event_type")
    typed = typed.where(matches(F.col("event_type"), "VIEW", case_sensitive=False))
    return named.select(
        F.lit("part").alias("kind"), F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("label")
    ).unionByName(
        typed.select(
            F.lit("event").alias("kind"), F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("label")
        )
    )


@query
def union_by_name(spark, sf_dir):
    """Suppliers in place of the customers with their keys; columns in another order, one missing."""
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return replace_by_key(customer, supplier.select("key"), supplier, "key", minimum=None)


# Keyed changes and sinks ------------------------------------------------------------------------


def _urgent(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("o_orderpriority") == "1-URGENT")


def _reopened(orders: DataFrame) -> DataFrame:
    """Recomputed rows for the urgent orders: fewer columns, another status."""
    return _urgent(orders).select("o_orderkey", "o_custkey", F.lit("R").alias("o_orderstatus"))


@query
def delete_keys(spark, sf_dir):
    """Urgent orders go, except those whose key is refused."""
    orders = table(spark, sf_dir, "orders")
    return delete_by_key(orders, _urgent(orders).select("o_orderkey"), "o_orderkey")


@query
def replace_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return replace_by_key(orders, _urgent(orders).select("o_orderkey"), _reopened(orders), "o_orderkey")


def _event_target(spark, sf_dir):
    """(newest event per user and type before a day, all events from that day on)."""
    events = table(spark, sf_dir, "events").select(*TARGET_COLUMNS)
    split = F.lit(UPSERT_FROM).cast("timestamp_ntz")
    target = newest_per_key(
        events.where(F.col("ts") < split), ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()]
    )
    return target, events.where(F.col("ts") >= split)


def _upsert_order():
    return [F.col("ts").desc(), F.col("event_id").desc()]


@query
def upsert_merge(spark, sf_dir):
    target, updates = _event_target(spark, sf_dir)
    return merge_upsert(
        target, updates, ["user_id", "event_type"], ["event_id", "value", "ts"], _upsert_order()
    )


@query
def upsert_inline(spark, sf_dir):
    """Literal rows as the update, stamped with their load time."""
    events = table(spark, sf_dir, "events").select(*TARGET_COLUMNS)
    target = newest_per_key(events, ["user_id", "event_type"], _upsert_order())
    schema = T.StructType([target.schema[name] for name in TARGET_COLUMNS[:4]])
    updates = inline_rows(
        spark, schema, [(1, "click", -1, 0.5), (2, "view", -2, 1.5), (-7, "click", -3, 2.5)]
    )
    return merge_upsert(
        target,
        updates,
        ["user_id", "event_type"],
        ["event_id", "value"],
        [F.col("event_id").desc()],
        {"ts": F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")},
    )


@query
def upsert_table(spark, sf_dir):
    """The same upsert through the stored table."""
    target, updates = _event_target(spark, sf_dir)
    stored = ReportTable(
        spark, scratch_path(spark, "upsert"), target.schema, ["user_id", "event_type"], buckets=8
    )
    stored.append(target)
    stored.upsert(updates, ["event_id", "value", "ts"], _upsert_order())
    return stored.read()


def _stored_orders(spark, sf_dir) -> ReportTable:
    orders = table(spark, sf_dir, "orders")
    stored = ReportTable(spark, scratch_path(spark, "orders"), orders.schema, ["o_orderkey"], width=100_000)
    stored.append(orders)
    return stored


@query
def delete_table(spark, sf_dir):
    stored = _stored_orders(spark, sf_dir)
    stored.delete(_urgent(table(spark, sf_dir, "orders")).select("o_orderkey"))
    return stored.read()


@query
def replace_table(spark, sf_dir):
    stored = _stored_orders(spark, sf_dir)
    orders = table(spark, sf_dir, "orders")
    rows = _urgent(orders).withColumn("o_orderstatus", F.lit("R"))
    stored.replace(_urgent(orders).select("o_orderkey"), rows)
    return stored.read()


def _line_rules():
    return {
        "no discount": F.col("l_discount") > 0,
        "small quantity": F.col("l_quantity") >= 5,
        "shipped early": F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp_ntz"),
    }


@query
def quarantine_split(spark, sf_dir):
    """Bad lines with the first rule they break, good ones without."""
    good, bad = split_valid(table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_discount"), _line_rules())
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)
    return both.select(*LINE_ORDER, "reason")


@query
def quarantine_append(spark, sf_dir):
    """Good and bad rows of the table after one append."""
    lines = table(spark, sf_dir, "lineitem")
    stored = ReportTable(spark, scratch_path(spark, "lines"), lines.schema, ["l_orderkey"], buckets=8)
    stored.append(lines, _line_rules())
    kept = stored.read().withColumn("reason", F.lit("kept"))
    both = kept.unionByName(stored.quarantined())
    return both.groupBy("reason").agg(
        F.count("*").alias("row_count"), F.sum("l_quantity").alias("quantity")
    )


@query
def csv_roundtrip(spark, sf_dir):
    """Heat sheets written as CSV and read back."""
    sheet = _lower(heat_sheet(order_plant(spark, sf_dir)))
    path = scratch_path(spark, "csv")
    write_csv(sheet, path)
    return read_csv(spark, path, sheet.schema)


# The report -------------------------------------------------------------------------------------


@query
def heat_report_wide(spark, sf_dir):
    return _lower(heat_report(order_plant(spark, sf_dir)))


@query
def heat_report_corrected(spark, sf_dir):
    modes = dict.fromkeys(("energy", "times", "fanout"), "corrected")
    return _lower(heat_report(order_plant(spark, sf_dir), **modes))


@query
def heat_report_selected(spark, sf_dir):
    """The wide report of the heats that a relation names."""
    heats = _urgent(table(spark, sf_dir, "orders")).select(F.col("o_orderkey").cast("string").alias("heat_id"))
    return _lower(heat_report(order_plant(spark, sf_dir), heats))


def _report_target(spark: SparkSession) -> ReportTable:
    return ReportTable(spark, scratch_path(spark, "report"), REPORT, ["HEAT_ID_NUM"], width=100_000)


@query
def report_run(spark, sf_dir):
    """The newest 400 heat rows reported twice, the second time in place of the first.

    Heats with a number too small to delete are refused the second time, so they stay as they were.
    """
    src: SourceCatalog = order_plant(spark, sf_dir)
    target = _report_target(spark)
    run_report(spark, src, target, last_n=400)
    run_report(spark, src, target, last_n=400, replace=True)
    return _lower(target.read())


@query
def report_run_unlisted(spark, sf_dir):
    """Names of the reported heats that the report has no column for."""
    return run_report(spark, order_plant(spark, sf_dir), _report_target(spark), last_n=400).unlisted


@query
def heat_report_bucketed(spark, sf_dir):
    """The wide report over sources that are stored in buckets by their join keys."""
    name = f"plant_{uuid.uuid4().hex}_"
    buckets = buckets_for(table(spark, sf_dir, "lineitem").count())
    stored = order_plant(spark, sf_dir).store_bucketed(name, scratch_path(spark, "plant"), buckets)
    return _lower(heat_report(stored))


# Columns by which the benchmark tables' plant grows: its counters are keys of static tables.
PLANT_MARKS = {
    "melt_heat": "mlh_tap_date",
    "melt_heat_event": "mhv_date",
    "melt_heat_result": "mhr_lmf_enddate",
    "l2_l3_meas_result": "meas_time",
}


@query
def report_run_incremental(spark, sf_dir):
    """The report of a plant that grew between two runs; the second run computes only heats with new rows.

    Heats with a number too small to replace are refused by both.
    """
    target, state = _report_target(spark), scratch_path(spark, "marks")
    modes = dict.fromkeys(("energy", "times", "fanout"), "corrected")
    for earlier in (True, False):
        run_incremental(spark, order_plant(spark, sf_dir, earlier), target, state, PLANT_MARKS, **modes)
    return _lower(target.read())

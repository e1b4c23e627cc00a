"""The benchmark tables seen as plant tables, so the reports run on them unchanged.

``order_plant``: a heat is an order, its lines are events, consumptions, lab rows and additions.
``customer_plant``: a heat is a customer, orders are additions and their lines the materials, which
gives many additions and materials per heat.

Each function below is one plant table, built when a plan first asks for it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatwright.sources.catalog import SourceCatalog

# How benchmark codes stand for plant codes.
EVENT_CODES = {"AF": "AL018", "AO": "AL059", "NF": "ML01", "NO": "AL021", "RF": "AL062", "RO": "MC026"}
ELEMENT_NAMES = {
    "STANDARD": "C", "ECONOMY": "Si", "MEDIUM": "Mn", "PROMO": "Xx", "LARGE": "DI Value", "SMALL": "Cr",
}
MATERIALS = {
    "STANDARD": "Lime", "ECONOMY": "Al Wire", "MEDIUM": "FeSi", "PROMO": "Sand", "LARGE": "MIX",
    "SMALL": "Coke",
}
PARAMETERS = {"click": "O2", "purchase": "CO2", "view": "TEMP", "signup": "TEMP", "error": "SLAG"}
AREAS = {"click": "LMS1", "purchase": "XLMS", "view": "LMS2", "signup": "VTD1", "error": "LMS1"}

Tables = Callable[[str], DataFrame]
View = Callable[[Tables], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _coded(column: Column, codes: dict[str, str]) -> Column:
    chain = F
    for value, code in codes.items():
        chain = chain.when(column == value, F.lit(code))
    return chain


def _prefixed(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _order_heat() -> Column:
    return F.col("o_orderkey").cast("string")


def _line_heat() -> Column:
    return F.col("l_orderkey").cast("string")


def _line_length() -> Column:
    return F.when(F.col("l_returnflag") != "A", F.col("l_linenumber").cast("double"))


def _typed_lines(t: Tables) -> DataFrame:
    types = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return t("lineitem").join(types, "l_partkey")


def melt_heat(t: Tables) -> DataFrame:
    return t("orders").select(
        _order_heat().alias("mlh_heat_no"),
        F.col("o_orderdate").alias("mlh_tap_date"),
        F.col("o_orderpriority").alias("blg_grade_id"),
        F.col("o_custkey").alias("eqg_serial_no"),
        _prefixed("C", "o_custkey").alias("wor_order_no"),
    )


def melt_heat_result(t: Tables) -> DataFrame:
    pounds = F.col("l_quantity") * 1000
    # Grouped by the heat as it is joined, so that the rows are dealt out by it once.
    lines = t("lineitem").groupBy(_line_heat().alias("mlh_heat_no"))
    return lines.agg(
        F.max("l_linenumber").cast("string").alias("mhr_crew_id"),
        F.min("l_linenumber").cast("string").alias("mhr_shift_id"),
        F.sum(F.when(F.col("l_returnflag") == "R", pounds).otherwise(0.0)).alias("mhr_prime_weight"),
        F.sum(pounds).alias("mhr_tap_weight"),
        F.max("l_extendedprice").alias("mhr_lmf_finaltemp"),
        F.min("l_extendedprice").alias("mhr_lmf_finalo2"),
        F.max("l_quantity").alias("mhr_lmf_finalc"),
        F.min("l_shipdate").alias("mhr_lmf_startdate"),
        F.max("l_shipdate").alias("mhr_lmf_enddate"),
    )


def melt_heat_consumption(t: Tables) -> DataFrame:
    return t("lineitem").select(
        _line_heat().alias("mlh_heat_no"),
        F.when(F.col("l_returnflag") == "A", "Energy").otherwise("Alloy").alias("mtg_group_id"),
        F.when(F.col("l_linestatus") == "O", 4).otherwise(3).alias("wcr_work_center_id"),
        F.col("l_quantity").alias("mhp_qty"),
    )


def work_order_link(t: Tables) -> DataFrame:
    return t("customer").select(
        _prefixed("C", "c_custkey").alias("wol_supply_no"),
        _prefixed("D", "c_nationkey").alias("wol_demand_no"),
    )


def work_order(t: Tables) -> DataFrame:
    demand = t("nation").select(
        _prefixed("D", "n_nationkey").alias("wor_order_no"), F.col("n_name").alias("pcd_product_code")
    )
    supply = t("customer").select(
        _prefixed("C", "c_custkey").alias("wor_order_no"),
        _prefixed("P", "c_nationkey").alias("pcd_product_code"),
    )
    return demand.unionByName(supply)


def product_code_route(t: Tables) -> DataFrame:
    return t("supplier").select(
        _prefixed("P", "s_nationkey").alias("pcd_product_code"),
        F.col("s_name").alias("sop_practice_id"),
        _prefixed("R", "s_suppkey").alias("rot_route_id"),
        F.lit(1).alias("ros_route_seq"),
        _prefixed("F", "s_nationkey").alias("finishing_route_id"),
    )


def route_sequence(t: Tables) -> DataFrame:
    return t("supplier").select(
        _prefixed("R", "s_suppkey").alias("rot_route_id"),
        F.lit(1).alias("ros_route_seq"),
        F.when(F.col("s_acctbal") > 3000, 4).otherwise(3).alias("wcr_work_center_id"),
    )


def multiple_route(t: Tables) -> DataFrame:
    """The last supplier of a nation is its primary route, the first another one."""
    ends = t("supplier").groupBy("s_nationkey").agg(F.max("s_suppkey"), F.min("s_suppkey"))
    ends = ends.toDF("s_nationkey", "last_supplier", "first_supplier")
    route = F.explode(
        F.array(
            F.struct(_prefixed("R", "last_supplier").alias("id"), F.lit(1).alias("primary")),
            F.struct(_prefixed("R", "first_supplier").alias("id"), F.lit(0).alias("primary")),
        )
    )
    return ends.withColumn("route", route).select(
        _prefixed("P", "s_nationkey").alias("pcd_product_code"),
        F.col("route.id").alias("rot_route_id"),
        _prefixed("F", "s_nationkey").alias("finishing_route_id"),
        F.col("route.primary").alias("mur_primary"),
    )


def v_ms_summary(t: Tables) -> DataFrame:
    uncast = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    return t("orders").select(
        _order_heat().alias("mlh_heat_no"),
        F.col("o_orderpriority").alias("blg_grade_id"),
        F.when(~uncast, F.col("o_orderdate")).alias("mlh_cast_date"),
        _coded(F.col("o_orderstatus"), {"F": "0", "O": "1"}).alias("mhr_cc_freeopen"),
        F.col("o_orderstatus").alias("mhr_crew_id"),
    )


def melt_heat_event(t: Tables) -> DataFrame:
    return t("lineitem").select(
        _line_heat().alias("mlh_heat_no"),
        _coded(F.concat("l_returnflag", "l_linestatus"), EVENT_CODES).alias("mev_event_id"),
        F.col("l_shipdate").alias("mhv_date"),
    )


def l2_l3_message(t: Tables) -> DataFrame:
    return t("events").select(
        F.col("event_id").alias("msg_counter"),
        F.col("event_type").alias("msg_code"),
        F.col("props").alias("msg_name"),
        F.col("ts").alias("msg_created"),
    )


def l2_l3_parameter(t: Tables) -> DataFrame:
    return t("events").select(
        F.col("event_id").alias("msg_counter"),
        _coded(F.col("event_type"), PARAMETERS).alias("param_name"),
        F.col("value").alias("param_value_number"),
        F.when(F.col("event_type").isin("view", "signup"), "F").otherwise("ppm").alias("param_unit"),
    )


def l2_l3_meas_result(t: Tables) -> DataFrame:
    return t("events").select(
        F.col("event_id").alias("msg_counter"),
        _coded(F.col("event_type"), AREAS).alias("area_id"),
        F.col("user_id").cast("string").alias("heat_id"),
        F.col("ts").alias("meas_time"),
        F.col("event_type").alias("mode"),
        F.col("event_type").alias("meas_code"),
        F.lit(1).alias("param_count"),
    )


def l2_l3_chem_result(t: Tables) -> DataFrame:
    return t("lineitem").select(
        F.col("l_partkey").alias("msg_counter"),
        F.when(F.col("l_linenumber") == 7, "CCM1").otherwise("LMS1").alias("area_id"),
        _line_heat().alias("heat_id"),
        F.col("l_shipdate").alias("sample_time"),
        F.col("l_shipdate").alias("analysis_time"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("bad_sample"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("is_final"),
        F.col("l_linenumber").alias("elem_count"),
    )


def l2_l3_chem_result_element(t: Tables) -> DataFrame:
    return t("part").select(
        F.col("p_partkey").alias("msg_counter"),
        F.col("p_size").alias("elem_type"),
        _coded(F.col("p_type"), ELEMENT_NAMES).alias("elem_name"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_retailprice")).alias("elem_value"),
    )


def l2_l3_heat_addition(t: Tables) -> DataFrame:
    area = F.when(F.col("l_returnflag") == "N", "VTD1").otherwise(
        _coded(F.col("l_linestatus"), {"O": "LMS1", "F": "LMS2"})
    )
    return t("lineitem").select(
        F.col("l_partkey").alias("msg_counter"),
        F.col("l_linenumber").alias("addition_no"),
        area.alias("area_id"),
        _line_heat().alias("heat_id"),
        F.col("l_shipdate").alias("addition_time"),
    )


def l2_l3_heat_addition_material(t: Tables) -> DataFrame:
    return _typed_lines(t).select(
        F.col("l_partkey").alias("msg_counter"),
        F.col("l_linenumber").alias("addition_no"),
        _line_heat().alias("heat_id"),
        _coded(F.col("p_type"), MATERIALS).alias("material_id"),
        F.col("l_quantity").alias("weight_act"),
        _line_length().alias("length_act"),
    )


def l2_l3_heat_report_ccm(t: Tables) -> DataFrame:
    return t("lineitem").select(
        F.col("l_returnflag").alias("area_id"),
        _line_heat().alias("heat_id"),
        F.col("l_linestatus").alias("heat_order_id"),
        F.col("l_linenumber").cast("string").alias("grade_id"),
    )


def l2_l3_heat_report_lms(t: Tables) -> DataFrame:
    amounts = ["total_treatment_time", "total_energy", "total_power_on", "total_alloys"]
    return t("orders").select(
        F.col("o_orderkey").alias("report_no"),
        (F.col("o_custkey") + 1100000000).cast("string").alias("heat_id"),
        F.col("o_orderpriority").alias("area_id"),
        F.col("o_orderstatus").alias("heat_order_id"),
        F.col("o_orderdate").alias("heat_start"),
        F.col("o_orderdate").alias("heat_stop"),
        *[F.col("o_totalprice").alias(name) for name in amounts],
    )


def rpt_ref(t: Tables) -> DataFrame:
    stand_ins = {
        "l_orderkey": ["report_no"],
        "l_returnflag": ["plant_id"],
        "l_linenumber": ["stand_no"],
        "l_shipdate": [
            "ladle_arrival", "ladle_departure", "leak_rate_filter_date", "leak_rate_filter_and_tank_date",
        ],
        "l_quantity": [
            "initial_metal_weight", "initial_slag_weight", "final_metal_weight", "final_slag_weight",
            "degassing_time", "req_degassing_time",
        ],
        "l_extendedprice": [
            "actual_target_temp_min", "actual_target_temp_aim", "actual_target_temp_max",
            "est_temp_at_stop", "deep_vacuum_time", "pump_down_time", "leak_rate_filter",
            "leak_rate_filter_and_tank",
        ],
    }
    return t("lineitem").select(
        *[F.col(source).alias(name) for source, names in stand_ins.items() for name in names]
    )


def customer_addition(t: Tables) -> DataFrame:
    area = F.when(F.col("o_orderpriority") == "1-URGENT", "VTD1").otherwise(
        F.concat(F.lit("LMS"), F.substring("o_orderpriority", 1, 1))
    )
    return t("orders").select(
        F.col("o_orderkey").alias("msg_counter"),
        F.lit(1).alias("addition_no"),
        area.alias("area_id"),
        F.col("o_custkey").cast("string").alias("heat_id"),
        F.col("o_orderdate").alias("addition_time"),
    )


def customer_material(t: Tables) -> DataFrame:
    customers = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return (
        _typed_lines(t)
        .join(customers, "l_orderkey")
        .select(
            F.col("l_orderkey").alias("msg_counter"),
            F.col("l_linenumber").alias("addition_no"),
            F.col("o_custkey").cast("string").alias("heat_id"),
            _coded(F.col("p_type"), MATERIALS).alias("material_id"),
            F.col("l_quantity").alias("weight_act"),
            _line_length().alias("length_act"),
        )
    )


ORDER_PLANT: dict[str, View] = {
    view.__name__: view
    for view in (
        melt_heat,
        melt_heat_result,
        melt_heat_consumption,
        work_order_link,
        work_order,
        product_code_route,
        route_sequence,
        multiple_route,
        v_ms_summary,
        melt_heat_event,
        l2_l3_message,
        l2_l3_parameter,
        l2_l3_meas_result,
        l2_l3_chem_result,
        l2_l3_chem_result_element,
        l2_l3_heat_addition,
        l2_l3_heat_addition_material,
        l2_l3_heat_report_ccm,
        l2_l3_heat_report_lms,
        rpt_ref,
    )
}
CUSTOMER_PLANT: dict[str, View] = {
    "l2_l3_heat_addition": customer_addition,
    "l2_l3_heat_addition_material": customer_material,
}


# A day on which about two thirds of the rows were there, and the columns that tell.
EARLIER = {"orders": ("o_orderdate", "2000-01-01"), "lineitem": ("l_shipdate", "2000-01-01"), "events": ("ts", "2024-01-20")}


def _plant(spark: SparkSession, sf_dir: str, views: dict[str, View], earlier: bool = False) -> SourceCatalog:
    read: dict[str, DataFrame] = {}

    def tables(name: str) -> DataFrame:
        if name not in read:
            read[name] = table(spark, sf_dir, name)
            if earlier and name in EARLIER:
                column, day = EARLIER[name]
                read[name] = read[name].where(F.col(column) < F.lit(day).cast("timestamp_ntz"))
        return read[name]

    return SourceCatalog({name: (lambda view=view: view(tables)) for name, view in views.items()})


def order_plant(spark: SparkSession, sf_dir: str, earlier: bool = False) -> SourceCatalog:
    """The plant of orders; ``earlier`` as it stood some time ago."""
    return _plant(spark, sf_dir, ORDER_PLANT, earlier)


def customer_plant(spark: SparkSession, sf_dir: str) -> SourceCatalog:
    return _plant(spark, sf_dir, CUSTOMER_PLANT)

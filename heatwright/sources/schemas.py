"""Declared schemas of the source tables, the vocabularies, and the layout of the wide report."""

from __future__ import annotations

from pyspark.sql import types as T

from heatwright.functions.scalars import wide_name


KINDS = {
    "str": T.StringType(),
    "int": T.IntegerType(),
    "big": T.LongType(),
    "dbl": T.DoubleType(),
    "ntz": T.TimestampNTZType(),
}


def _schema(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in fields])


# Tables of the production database.
PRODUCTION = {
    "v_ms_summary": [
        ("mlh_heat_no", "str"), ("blg_grade_id", "str"), ("mlh_cast_date", "ntz"),
        ("mhr_cc_freeopen", "str"), ("mhr_crew_id", "str"),
    ],
    "melt_heat_event": [
        ("mlh_heat_no", "str"), ("mev_event_id", "str"), ("mhv_date", "ntz"),
    ],
    "melt_heat": [
        ("mlh_heat_no", "str"), ("mlh_tap_date", "ntz"), ("blg_grade_id", "str"),
        ("eqg_serial_no", "big"), ("wor_order_no", "str"),
    ],
    "melt_heat_result": [
        ("mlh_heat_no", "str"), ("mhr_crew_id", "str"), ("mhr_shift_id", "str"),
        ("mhr_prime_weight", "dbl"), ("mhr_tap_weight", "dbl"), ("mhr_lmf_finaltemp", "dbl"),
        ("mhr_lmf_finalo2", "dbl"), ("mhr_lmf_finalc", "dbl"), ("mhr_lmf_startdate", "ntz"),
        ("mhr_lmf_enddate", "ntz"),
    ],
    "melt_heat_consumption": [
        ("mlh_heat_no", "str"), ("mtg_group_id", "str"), ("wcr_work_center_id", "int"),
        ("mhp_qty", "dbl"),
    ],
    "work_order_link": [
        ("wol_supply_no", "str"), ("wol_demand_no", "str"),
    ],
    "work_order": [
        ("wor_order_no", "str"), ("pcd_product_code", "str"),
    ],
    "product_code_route": [
        ("pcd_product_code", "str"), ("sop_practice_id", "str"), ("rot_route_id", "str"),
        ("ros_route_seq", "int"), ("finishing_route_id", "str"),
    ],
    "route_sequence": [
        ("rot_route_id", "str"), ("ros_route_seq", "int"), ("wcr_work_center_id", "int"),
    ],
    "multiple_route": [
        ("pcd_product_code", "str"), ("rot_route_id", "str"), ("finishing_route_id", "str"),
        ("mur_primary", "int"),
    ],
}

# Tables of the process-control database.
PROCESS_CONTROL = {
    "l2_l3_heat_report_lms": [
        ("report_no", "big"), ("heat_id", "str"), ("area_id", "str"), ("heat_order_id", "str"),
        ("heat_start", "ntz"), ("heat_stop", "ntz"), ("total_treatment_time", "dbl"),
        ("total_energy", "dbl"), ("total_power_on", "dbl"), ("total_alloys", "dbl"),
    ],
    "rpt_ref": [
        ("report_no", "big"), ("plant_id", "str"), ("stand_no", "int"), ("ladle_arrival", "ntz"),
        ("ladle_departure", "ntz"), ("initial_metal_weight", "dbl"), ("initial_slag_weight", "dbl"),
        ("final_metal_weight", "dbl"), ("final_slag_weight", "dbl"), ("degassing_time", "dbl"),
        ("req_degassing_time", "dbl"), ("actual_target_temp_min", "dbl"),
        ("actual_target_temp_aim", "dbl"), ("actual_target_temp_max", "dbl"),
        ("est_temp_at_stop", "dbl"), ("deep_vacuum_time", "dbl"), ("pump_down_time", "dbl"),
        ("leak_rate_filter", "dbl"), ("leak_rate_filter_date", "ntz"),
        ("leak_rate_filter_and_tank", "dbl"), ("leak_rate_filter_and_tank_date", "ntz"),
    ],
    "l2_l3_heat_report_ccm": [
        ("area_id", "str"), ("heat_id", "str"), ("heat_order_id", "str"), ("grade_id", "str"),
    ],
    "l2_l3_message": [
        ("msg_counter", "big"), ("msg_code", "str"), ("msg_name", "str"), ("msg_created", "ntz"),
    ],
    "l2_l3_parameter": [
        ("msg_counter", "big"), ("param_name", "str"), ("param_value_number", "dbl"),
        ("param_unit", "str"),
    ],
    "l2_l3_meas_result": [
        ("msg_counter", "big"), ("area_id", "str"), ("heat_id", "str"), ("meas_time", "ntz"),
        ("mode", "str"), ("meas_code", "str"), ("param_count", "int"),
    ],
    "l2_l3_chem_result": [
        ("msg_counter", "big"), ("area_id", "str"), ("heat_id", "str"), ("sample_time", "ntz"),
        ("analysis_time", "ntz"), ("bad_sample", "int"), ("is_final", "int"), ("elem_count", "int"),
    ],
    "l2_l3_chem_result_element": [
        ("msg_counter", "big"), ("elem_type", "int"), ("elem_name", "str"), ("elem_value", "dbl"),
    ],
    "l2_l3_heat_addition": [
        ("msg_counter", "big"), ("addition_no", "int"), ("area_id", "str"), ("heat_id", "str"),
        ("addition_time", "ntz"),
    ],
    "l2_l3_heat_addition_material": [
        ("msg_counter", "big"), ("addition_no", "int"), ("heat_id", "str"), ("material_id", "str"),
        ("weight_act", "dbl"), ("length_act", "dbl"),
    ],
}

SOURCES: dict[str, T.StructType] = {
    name: _schema(fields) for name, fields in {**PRODUCTION, **PROCESS_CONTROL}.items()
}

# Identifier columns that some systems deliver padded.
HEAT_ID_COLUMNS = frozenset({"heat_id", "mlh_heat_no"})

# Key that each source of the wide report is joined and grouped by first.
CLUSTERED_BY = {
    "melt_heat": "mlh_heat_no",
    "melt_heat_result": "mlh_heat_no",
    "melt_heat_consumption": "mlh_heat_no",
    "melt_heat_event": "mlh_heat_no",
    "v_ms_summary": "mlh_heat_no",
    "l2_l3_message": "msg_counter",
    "l2_l3_parameter": "msg_counter",
    "l2_l3_meas_result": "msg_counter",
    "l2_l3_chem_result": "msg_counter",
    "l2_l3_chem_result_element": "msg_counter",
    "l2_l3_heat_addition": "heat_id",
    "l2_l3_heat_addition_material": "heat_id",
}

# Upsert target: neighbours of a device.
NEIGHBOURS = T.StructType(
    [
        T.StructField("hostname", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("neighborHostname", T.StringType()),
        T.StructField("neighborIP", T.StringType()),
        T.StructField("lastUpdate", T.TimestampNTZType()),
    ]
)

# The vocabularies of the two pivots, in report order.
ADDITIONS = [
    "AlWire", "Al Wire", "Argon", "BAUXITE", "CaSi", "FeV", "Chrome", "Coke", "Dolime", "FeSi",
    "Inj C", "Lime", "Low Sulfur Carbon", "MIX", "NaturalGas", "Natural Gas", "Nitrogen", "Oxygen",
    "SAF", "SiMn", "FeMn",
]
ELEMENTS = [
    "Fe", "C", "Si", "Mn", "P", "S", "Cr", "Mo", "Ni", "Al", "As", "B", "Co", "Cu", "Nb", "W",
    "Pb", "Sn", "Sb", "Ti", "V", "Bi", "Zr", "Se", "Zn", "Ce", "Hg", "Cd", "Ta", "Te", "LecoC",
    "LecoN", "LecoS", "LecoO", "LQD", "J1", "J2", "J3", "J4", "J5", "J6", "J7", "J8", "J9", "J10",
    "J12", "J14", "J16", "J18", "J20", "J24", "J28", "J32", "DI Value",
]

# The report layout.
HEAT_SHEET_FIELDS = [
    ("HEAT_ID", "str"), ("TAP_DATE", "ntz"), ("CREW", "str"), ("SHIFT_ID", "str"),
    ("WOL_DEMAND_NO", "str"), ("PCD_PRODUCT_CODE", "str"), ("BLG_GRADE_ID", "str"),
    ("EQG_SERIAL_NO", "big"), ("LMF_KWH", "dbl"), ("KWH_TON", "dbl"), ("TAP_TEMP", "dbl"),
    ("TAP_OXYGEN", "dbl"), ("TAP_CARBON", "dbl"), ("TAP_WEIGHT", "dbl"), ("CAST_TON", "dbl"),
    ("MHR_LMF_STARTDATE", "ntz"), ("MHR_LMF_ENDDATE", "ntz"), ("TREATMENT_TIME", "dbl"),
    ("SOP_PRACTICE_ID", "str"),
]
MEASUREMENT_FIELDS = [
    ("O2_VALUE", "dbl"), ("O2_UNITS", "str"), ("O2_AREA", "str"),
    ("TEMP_VALUE", "dbl"), ("TEMP_UNITS", "str"), ("TEMP_AREA", "str"), ("TEMP_MEAS_TIME", "ntz"),
]
ADDITION_FIELDS = [
    (wide_name(prefix, name), "dbl") for name in ADDITIONS for prefix in ("WEIGHT_", "LENGTH_")
]
ELEMENT_FIELDS = [(wide_name("TOTAL_", name), "dbl") for name in ELEMENTS]
STIR_FIELDS = [
    ("QMOS_GRADE", "str"), ("QMOS_STIR_ON", "str"), ("QMOS_STIR_OFF", "str"),
    ("QMOS_FREE_OPEN", "str"),
]
KEY_FIELDS = [("HEAT_ID_NUM", "big")]

REPORT = _schema(
    HEAT_SHEET_FIELDS
    + MEASUREMENT_FIELDS
    + ADDITION_FIELDS
    + ELEMENT_FIELDS
    + STIR_FIELDS
    + KEY_FIELDS
)
HEAT_SHEET_COLUMNS = [name for name, _ in HEAT_SHEET_FIELDS]

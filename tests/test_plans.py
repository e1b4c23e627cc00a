import re

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from heatwright import (
    additions_by_heat,
    additions_detail,
    chemistry,
    heat_list,
    heat_report,
    heat_sheet,
    last_heats,
    latest_chemistry,
    latest_measurement,
    ref_report,
    stir_ladle_times,
)
from heatwright.operators.pivots import pivot_vocabulary, unlisted
from heatwright.operators.quality import repeated_keys
from heatwright.plans.chemistry import element_summary, element_values, latest_elements
from heatwright.plans.heat_report import named_totals, unlisted_names
from heatwright.plans.measurements import OXYGEN, TEMPERATURE
from heatwright.sources.catalog import Near, SourceCatalog, buckets_for, inline_rows
from heatwright.sources.schemas import ADDITIONS, CLUSTERED_BY, ELEMENTS, REPORT, SOURCES

SHEET = ("HEAT_ID", "WOL_DEMAND_NO", "PCD_PRODUCT_CODE", "LMF_KWH", "KWH_TON", "TAP_WEIGHT", "CAST_TON",
         "TREATMENT_TIME", "SOP_PRACTICE_ID")


def test_heat_sheet_reference_energy(plant):
    assert rows(heat_sheet(plant), *SHEET) == [
        (None, "D3", "P3", None, None, None, None, None, None),
        ("1100000001", "D1", "P1", 3000.0, 20.0, 155.0, 150.0, 1830.0, "S1"),
        ("1100000002", "D2", "P2", 80.0, None, 100.0, 0.0, None, None),
    ]


def test_heat_sheet_corrected_energy(plant):
    got = rows(heat_sheet(plant, energy="corrected"), "HEAT_ID", "LMF_KWH", "KWH_TON")
    assert got == [(None, None, None), ("1100000001", 1500.0, 10.0), ("1100000002", 40.0, None)]


def test_reference_energy_needs_a_result_row(spark, plant):
    empty = SourceCatalog.from_frames({"melt_heat_result": inline_rows(spark, SOURCES["melt_heat_result"], [])})
    got = rows(heat_sheet(plant.merged(empty)), "WOL_DEMAND_NO", "LMF_KWH")
    assert got == [("D1", None), ("D2", None), ("D3", None)]


def test_several_primary_routes_fan_out(spark, plant):
    both = SourceCatalog.from_frames(
        {
            "multiple_route": inline_rows(
                spark, SOURCES["multiple_route"], [("P1", "R1", "F1", 1), ("P1", "R2", "F1", 1)]
            )
        }
    )
    sheet = heat_sheet(plant.merged(both), "1100000001")
    assert rows(sheet, "SOP_PRACTICE_ID") == [("S1",), ("S1b",)]
    assert rows(repeated_keys(sheet, ["HEAT_ID"])) == [("1100000001", 2)]


def test_heat_filters_agree(spark, plant):
    by_list = rows(heat_sheet(plant, heat_list(spark, [1100000001, "1100000002 "])))
    by_pattern = rows(heat_sheet(plant, "%00000_"))
    assert by_list == [row for row in by_pattern if row[0] is not None]


STIR = ("HEAT_ID", "STIR ON", "STIR OFF", "LADLE ARRIVAL")


def _text(*hours, day="06-01-2024"):
    return tuple(f"{day} {hour}:00" for hour in hours)


def test_milestones_reference(plant):
    got = rows(stir_ladle_times(plant).where("HEAT_ID < 'Z' AND HEAT_ID >= 'A'"), *STIR)
    assert got == [
        ("A", *_text("10:15", "10:35", "10:50")),
        ("B", *_text("12:05", "12:50", "12:50")),
        ("C", *_text("14:30", "14:45", "14:45")),
        ("D", "12-31-2023 23:50:00", "01-01-2024 00:40:00", "01-01-2024 00:40:00"),
        ("E", *_text("16:30", "16:10", "16:50")),
    ]


def test_milestones_corrected_only_changes_the_year_end(plant):
    reference = rows(stir_ladle_times(plant), *STIR)
    corrected = rows(stir_ladle_times(plant, times="corrected"), *STIR)
    changed = [row for row in corrected if row not in reference]
    assert changed == [("D", *_text("00:05", "00:20", "00:40", day="01-01-2024"))]
    assert len(corrected) == len(reference)


def test_milestone_flags_and_dropped_heats(plant):
    got = rows(stir_ladle_times(plant), "HEAT_ID", "FREE OPEN", "CREW", "LADLE OPEN")
    flags = {row[0]: row[1] for row in got if len(row[0]) == 1}
    assert flags == {"A": "FALSE", "B": "TRUE", "C": "TRUE", "D": "TRUE", "E": "TRUE"}
    assert got.count(("A", "FALSE", "C1", "06-01-2024 18:00:00")) == 1


def test_newest_cast_first(plant):
    got = [row["CAST_DATE"] for row in stir_ladle_times(plant, newest_first=True).collect()]
    assert got == sorted(got, reverse=True)


ADDED = ("area_id", "material_id", "min_add_time", "max_add_time", "weight_act", "length_act")


def test_additions_reference(plant):
    span, last = (at("10:11"), at("10:16")), (at("10:21"), at("10:21"))
    assert rows(additions_by_heat(plant, "A"), *ADDED) == [
        ("LMS1", "Al Wire", *span, None, 60.0),
        ("LMS1", "FeSi", *span, 40.0, 0.0),
        ("LMS1", "Lime", *span, 2298.0, None),
        ("LMS1", "Sand", *span, 10.0, 0.0),
        ("LMS2", "Al Wire", *last, None, 30.0),
        ("LMS2", "FeSi", *last, 20.0, 0.0),
        ("LMS2", "Lime", *last, 1149.0, None),
        ("LMS2", "Sand", *last, 5.0, 0.0),
    ]


def test_additions_corrected(plant):
    assert rows(additions_by_heat(plant, "A", fanout="corrected"), *ADDED) == [
        ("LMS1", "Al Wire", at("10:16"), at("10:16"), None, 30.0),
        ("LMS1", "Lime", at("10:11"), at("10:16"), 150.0, None),
        ("LMS2", "FeSi", at("10:21"), at("10:21"), 20.0, 0.0),
        ("LMS2", "Sand", at("10:21"), at("10:21"), 5.0, 0.0),
    ]


def test_modes_agree_with_one_addition(plant):
    reference = rows(additions_by_heat(plant, "1100000001"))
    assert reference == rows(additions_by_heat(plant, "1100000001", fanout="corrected"))


def test_additions_limit_is_ordered(plant):
    first = additions_by_heat(plant, "A", limit=3)
    assert [row["material_id"] for row in first.collect()] == ["Al Wire", "FeSi", "Lime"]


def test_addition_pivot_and_unlisted(plant):
    added = additions_by_heat(plant, "A")
    wide = pivot_vocabulary(
        added, "heat_id", "material_id", {"weight_act": "WEIGHT_", "length_act": "LENGTH_"}, ADDITIONS, ["area_id"]
    ).collect()
    assert len(wide) == 1
    cells = wide[0].asDict()
    assert cells.pop("heat_id") == "A"
    special = {
        "WEIGHT_Lime": 1149.0, "LENGTH_Lime": None, "WEIGHT_Al_Wire": None, "LENGTH_Al_Wire": 30.0,
        "WEIGHT_FeSi": 20.0, "LENGTH_FeSi": 0.0,
    }
    assert {name: cells.pop(name) for name in special} == special
    assert len(cells) == 36 and set(cells.values()) == {0.0}
    assert rows(unlisted(added, "material_id", ADDITIONS)) == [("Sand", 2)]


def test_additions_detail_matches_plain_join(plant):
    additions = plant["l2_l3_heat_addition"].where("area_id LIKE 'LMS%'")
    materials = plant["l2_l3_heat_addition_material"].withColumnRenamed("addition_no", "material_no")
    plain = additions.join(materials, ["heat_id", "msg_counter"], "left").orderBy(
        F.col("heat_id").desc(), F.col("addition_no").desc(), F.col("material_no").desc()
    )
    columns = ["heat_id", "addition_no", "material_no", "material_id"]
    for limit in (1, 2, 4, 100):
        got = [tuple(r) for r in additions_detail(plant, limit).select(*columns).collect()]
        assert got == [tuple(r) for r in plain.select(*columns).limit(limit).collect()]


def test_chemistry_filters_and_keeps_bare_results(plant):
    got = rows(chemistry(plant, "A"), "msg_counter", "elem_type")
    assert got == [(20, 1), (20, 2), (20, 99), (30, 1), (30, 2), (30, 3), (70, None)]


@pytest.mark.parametrize("scope", ["heat", "all"])
def test_chemistry_cap(plant, scope):
    got = rows(chemistry(plant, "A", scope=scope, limit=3), "msg_counter", "elem_type")
    assert got == [(30, 2), (30, 3), (70, None)]


def test_no_row_cap_by_default(spark, plant):
    """More lab rows in a heat than the old cap: the oldest element still counts."""
    many = SourceCatalog.from_frames(
        {
            "l2_l3_chem_result_element": plant["l2_l3_chem_result_element"].unionByName(
                spark.range(6000).selectExpr(
                    "80L AS msg_counter", "CAST(id + 100 AS INT) AS elem_type", "'Zr' AS elem_name", "1D AS elem_value"
                )
            )
        }
    )
    src = plant.merged(many)
    assert chemistry(src).where("heat_id = '1100000001'").count() == 6002
    assert rows(heat_report(src, ["1100000001"]), "TOTAL_C", "TOTAL_Zr") == [(0.07, 1.0)]


def test_chemistry_cap_keeps_results_without_a_number(spark, plant):
    none = plant["l2_l3_chem_result"].where("msg_counter = 20").withColumn("msg_counter", F.lit(None).cast("long"))
    src = plant.merged(
        SourceCatalog.from_frames({"l2_l3_chem_result": plant["l2_l3_chem_result"].unionByName(none)})
    )
    whole = chemistry(src).count()
    for limit in (3, whole, whole + 5):
        assert chemistry(src, scope="all", limit=limit).count() == min(limit, whole)


def test_heats_without_a_result_do_not_share_a_task(spark, plant):
    lonely = spark.range(300).selectExpr(
        "concat('9', id) AS mlh_heat_no", "timestamp_ntz'2024-06-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id) AS mlh_tap_date",
        "'G' AS blg_grade_id", "id AS eqg_serial_no", "'W1' AS wor_order_no",
    )
    src = plant.merged(SourceCatalog.from_frames({"melt_heat": plant["melt_heat"].unionByName(lonely)}))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sheet = heat_sheet(src)
        shares = sheet.where("HEAT_ID IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(row["count"] for row in shares) >= 300 and len(shares) > 2


def test_latest_chemistry_skips_nulls_per_column(plant):
    latest = latest_chemistry(chemistry(plant, "A"))
    assert rows(latest, "elem_type", "elem_name", "elem_value", "elem_count") == [
        (1, "C", 0.05, 3),
        (2, "Mn", 0.9, 3),
        (3, "DI Value", 2.5, 3),
        (99, "Xx", 1.0, 3),
    ]
    wide = pivot_vocabulary(latest, "heat_id", "elem_name", {"elem_value": "TOTAL_"}, ELEMENTS, ["elem_type"])
    cells = wide.first().asDict()
    assert (cells["TOTAL_C"], cells["TOTAL_Mn"], cells["TOTAL_DI_Value"]) == (0.05, 0.9, 2.5)
    assert sum(value == 0.0 for value in cells.values()) == 51
    assert rows(unlisted(latest, "elem_name", ELEMENTS)) == [("Xx", 1)]


def test_pivot_takes_the_greatest_type(spark):
    long = spark.createDataFrame(
        [("h", "C", 1, 1.0), ("h", "C ", 7, 2.0), ("h", None, 9, 3.0), (None, "C", 9, 4.0), ("n", "C", 1, None)],
        "heat string, name string, kind int, value double",
    )
    wide = pivot_vocabulary(long, "heat", "name", {"value": "T_"}, ["C", "Si"], ["kind"])
    assert rows(wide) == [("h", 2.0, 0.0), ("n", None, 0.0)]


def test_latest_measurement(plant):
    assert rows(latest_measurement(plant, **OXYGEN), "heat_id", "value", "units", "area") == [
        ("1100000001", 5.0, "ppm", "LMS1"),
        ("A", 4.0, "ppm", "XLMS"),
        ("C", 9.0, "ppm", "LMS1"),
    ]
    got = rows(latest_measurement(plant, **TEMPERATURE), "heat_id", "value", "area", "meas_time")
    assert got == [("A", 2900.0, "LMS1", at("10:25")), ("B", None, "LMS2", at("12:00"))]
    assert latest_measurement(plant, param_like="temp", area_like="lms%").count() == 0
    relaxed = latest_measurement(plant, param_like="temp", area_like="lms%", case_sensitive=False)
    assert rows(relaxed, "heat_id") == [("A",), ("B",)]


def test_measurement_ties(spark, plant):
    tied = SourceCatalog.from_frames(
        {
            "l2_l3_parameter": inline_rows(
                spark, SOURCES["l2_l3_parameter"], [(1, "O2b", 9.0, "x"), (1, "O2a", 1.0, "x"), (1, "O2a", 2.0, "x"),
                                                    (2, "O2z", 3.0, "x")]
            ),
            "l2_l3_meas_result": inline_rows(
                spark, SOURCES["l2_l3_meas_result"],
                [(1, "LMS1", "H", at("10:00"), "M", "1", 1), (1, "LMS1", "K", at("10:00"), "M", "1", 1),
                 (2, "LMS1", "K", at("10:00"), "M", "1", 1)],
            ),
        }
    )
    got = rows(latest_measurement(plant.merged(tied), **OXYGEN), "heat_id", "param_name", "value")
    assert got == [("H", "O2a", 2.0), ("K", "O2z", 3.0)]


def test_last_heats(plant):
    assert [tuple(r) for r in last_heats(plant, 2).collect()] == [
        ("CCM1", "1100000002", "O2", "G2"),
        ("CCM2", "1100000001", "O1", "G1"),
    ]
    assert last_heats(plant, 100).count() == 4


def _copies(df, n):
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("copy")


@pytest.mark.parametrize("limit", [1, 7, 60, 200])
def test_copies_of_a_key_never_multiply_out(plant, limit):
    """A report number and an addition with many copies on both sides."""
    many = SourceCatalog.from_frames(
        {
            name: plant[name].unionByName(_copies(plant[name].where(key), 40))
            for name, key in {
                "l2_l3_heat_report_lms": "report_no = 6",
                "rpt_ref": "report_no = 6",
                "l2_l3_heat_addition": "msg_counter = 3",
                "l2_l3_heat_addition_material": "msg_counter = 3",
            }.items()
        }
    )
    src = plant.merged(many)
    got = [tuple(r) for r in ref_report(src, limit=limit).select("heat_id", "stand_no").collect()]
    plain = ref_report(src, limit=None).orderBy(F.col("heat_id").desc())
    plain = plain.where("heat_id < '1100000099'").select("heat_id", "stand_no")
    assert got == [tuple(r) for r in plain.limit(limit).collect()]

    columns = ["heat_id", "addition_no", "material_no", "material_id"]
    additions = src["l2_l3_heat_addition"].where("area_id LIKE 'LMS%'")
    materials = src["l2_l3_heat_addition_material"].withColumnRenamed("addition_no", "material_no")
    plain = additions.join(materials, ["heat_id", "msg_counter"], "left").orderBy(
        *[F.col(c).desc() for c in columns]
    )
    got = [tuple(r) for r in additions_detail(src, limit).select(*columns).collect()]
    assert got == [tuple(r) for r in plain.select(*columns).limit(limit).collect()]


def test_copies_of_a_heat_give_the_same_main_rows(plant):
    doubled = SourceCatalog.from_frames(
        {name: _copies(plant[name], 3) for name in ("melt_heat_result", "work_order_link")}
    )
    got = rows(heat_sheet(plant.merged(doubled), energy="corrected"))
    assert got == rows(heat_sheet(plant, energy="corrected"))


def test_ref_report_cut_equals_plain_join(plant):
    for limit in (1, 3, 5, 50):
        got = ref_report(plant, limit=limit, min_heat=1100000000).where("heat_id < '1100000099'")
        plain = ref_report(plant, limit=None, min_heat=1100000000).where("heat_id < '1100000099'")
        plain = plain.orderBy(F.col("heat_id").desc()).limit(limit)
        assert rows(got, "heat_id", "plant_id") == rows(plain, "heat_id", "plant_id")


def test_ref_report_null_number_comes_last(plant):
    got = ref_report(plant, limit=50)
    assert got.count() == 9
    assert got.collect()[-1]["heat_id"] == "1100000099"


def test_ref_report_of_given_heats(spark, plant):
    wanted = [1100000006, "1100000007"]
    expected = [("1100000006",), ("1100000006",), ("1100000007",)]
    assert rows(ref_report(plant, wanted), "heat_id") == expected
    assert rows(ref_report(plant, heat_list(spark, wanted)), "heat_id") == expected


def test_ref_report_since(plant):
    assert rows(ref_report(plant, since="2024-06-01 10:04:59.999"), "heat_id") == [
        ("1100000001",), ("1100000002",), ("1100000003",), ("1100000006",), ("1100000006",),
    ]
    assert ref_report(plant, since="2024-06-01 10:05:00").count() == 0
    assert rows(ref_report(plant, since="2024-01-01", min_heat=1100000002, limit=2), "heat_id") == [
        ("1100000006",),
        ("1100000006",),
    ]


def test_report_has_the_declared_layout(plant):
    report = heat_report(plant)
    assert report.columns == REPORT.names and len(report.columns) == 127
    assert [f.dataType for f in report.schema] == [f.dataType for f in REPORT]


def test_report_rows(plant):
    report = {row["HEAT_ID"]: row.asDict() for row in heat_report(plant).collect()}
    assert set(report) == {None, "1100000001", "1100000002"}

    full = report["1100000001"]
    assert (full["O2_VALUE"], full["O2_UNITS"], full["O2_AREA"]) == (5.0, "ppm", "LMS1")
    assert (full["TEMP_VALUE"], full["TEMP_UNITS"], full["TEMP_AREA"]) == (0.0, "---", "---")
    assert full["TEMP_MEAS_TIME"] is None
    assert (full["WEIGHT_MIX"], full["LENGTH_MIX"], full["WEIGHT_Lime"]) == (7.0, None, 0.0)
    assert (full["TOTAL_C"], full["TOTAL_Cr"], full["TOTAL_Si"]) == (0.07, None, 0.0)
    assert (full["QMOS_GRADE"], full["QMOS_FREE_OPEN"]) == ("G1", "FALSE")
    assert full["QMOS_STIR_ON"] == "06-01-2024 10:12:00"
    assert full["HEAT_ID_NUM"] == 1100000001

    bare = report["1100000002"]
    assert (bare["O2_VALUE"], bare["O2_UNITS"]) == (0.0, "---")
    assert bare["WEIGHT_Lime"] == 0.0 and bare["TOTAL_Fe"] == 0.0 and bare["QMOS_GRADE"] is None

    nameless = report[None]
    added = [n for n in REPORT.names[19:] if n != "HEAT_ID_NUM"]
    assert all(nameless[name] is None for name in added) and nameless["HEAT_ID_NUM"] == 0


def test_one_heat_equals_its_row_of_the_whole(spark, plant):
    whole = [row for row in rows(heat_report(plant)) if row[0] == "1100000001"]
    assert rows(heat_report(plant, "1100000001")) == whole
    assert rows(heat_report(plant, heat_list(spark, ["1100000001"]))) == whole


def test_report_does_not_depend_on_partitioning(spark, plant):
    shuffled = SourceCatalog(
        {name: (lambda name=name: plant[name].orderBy(F.rand(7)).repartition(5)) for name in SOURCES}
    )
    assert rows(heat_report(shuffled)) == rows(heat_report(plant))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_sources_need_fewer_exchanges(spark, plant, tmp_path):
    stored = plant.store_bucketed("golden_", str(tmp_path / "stored"), buckets=4)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "4"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        plain = SourceCatalog.from_frames({name: plant[name] for name in SOURCES})
        counts = [_plan(heat_report(src)).count("Exchange hashpartitioning") for src in (plain, stored)]
        lab = [_plan(element_values(src)).count("Exchange") for src in (plain, stored)]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert lab == [2, 0]
    assert counts[1] <= counts[0] - 8
    assert rows(heat_report(stored)) == rows(heat_report(plant))
    again = SourceCatalog.from_tables(spark, "golden_", CLUSTERED_BY)
    assert rows(again["l2_l3_chem_result"]) == rows(plant["l2_l3_chem_result"])


def test_staged_totals_give_the_same_report(spark, plant):
    for fanout in ("reference", "corrected"):
        totals = named_totals(plant, fanout=fanout)
        assert rows(heat_report(plant, fanout=fanout, totals=totals)) == rows(heat_report(plant, fanout=fanout))
    assert rows(unlisted_names(named_totals(plant))) == [("element", "Xx", 1), ("material", "Sand", 1)]


def test_newest_elements_of_a_summary(spark, plant):
    names = ["heat_id", "elem_type", "elem_name", "elem_value"]
    whole = latest_chemistry(element_values(plant)).select(*names)
    assert rows(latest_elements(element_summary(plant))) == rows(whole)


def test_a_relation_of_heats_is_semi_joined_once(spark, plant):
    """Lookups are left joined to exact heats: their rows need no semi-join, and no sort, of their own."""
    heats = heat_list(spark, ["1100000001"])
    assert _plan(heat_report(plant, heats)).count("LeftSemi") == 1
    names = unlisted_names(named_totals(plant, Near(heats)), heats)
    assert rows(names) == rows(unlisted_names(named_totals(plant, heats)))


def test_the_heat_sheet_is_made_distinct_where_it_is_joined(spark, plant):
    """Rows of full width are laid out by the heat once, not by all of their columns before."""
    plan = _plan(heat_sheet(plant))
    assert not re.search(r"hashpartitioning\([^)]*TREATMENT_TIME", plan)


def test_buckets_grow_with_the_rows():
    assert buckets_for(0) == buckets_for(600_000) == 8
    assert buckets_for(216_000_000) == 864 and buckets_for(36_000_001) == 145

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from heatwright.session import local_session  # noqa: E402
from heatwright.sources.catalog import SourceCatalog, inline_rows  # noqa: E402
from heatwright.sources.schemas import SOURCES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        4, **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")}
    )
    yield session
    session.stop()


def at(text, day="2024-06-01"):
    """A time of the fixture's day, or a full timestamp."""
    return dt.datetime.fromisoformat(text if "-" in text else f"{day} {text}")


SUMMARY_TAIL = (at("17:00"), "0", "CR")

GOLDEN = {
    "melt_heat": [
        ("1100000001", at("10:00"), "G1", 10, "W1"),
        ("1100000002 ", at("12:00"), "G2", 11, "W2"),
        ("1100000003", at("14:00"), "G3", 12, "W3"),
        ("1100000004", at("16:00"), "G4", 13, "W9"),
    ],
    "melt_heat_result": [
        ("1100000001", "A", "1", 300000.0, 310000.0, 2900.0, 3.0, 0.05, at("10:10"), at("10:40:30")),
        ("1100000002", "B", "2", 0.0, 200000.0, None, None, None, at("12:10"), None),
    ],
    "melt_heat_consumption": [
        ("1100000001", "Energy", 4, 1000.0),
        ("1100000001", "Energy", 4, 500.0),
        ("1100000001", "Energy", 3, 99.0),
        ("1100000001", "Alloy", 4, 7.0),
        ("1100000002", "Energy", 4, 40.0),
    ],
    "work_order_link": [("W1", "D1"), ("W2", "D2"), ("W3", "D3")],
    "work_order": [("D1", "P1"), ("D2", "P2"), ("D3", "P3"), ("W1", "P1")],
    "product_code_route": [("P1", "S1", "R1", 1, "F1"), ("P1", "S1b", "R2", 1, "F1")],
    "route_sequence": [("R1", 1, 4), ("R2", 1, 4)],
    "multiple_route": [("P1", "R1", "F1", 1), ("P1", "R2", "F1", 0)],
    "v_ms_summary": [
        ("A", "GA", at("18:00"), "0", "C1"),
        ("A", "GA", at("18:00"), "0", "C1"),
        ("B", "GB", at("18:10"), "1", "C1"),
        ("C", "GC", at("18:20"), None, "C2"),
        ("D", "GD", at("2024-01-01 02:00"), "1", "C2"),
        ("E", "GE", at("18:40"), "1", "C2"),
        ("F", "GF", None, "1", "C2"),
        ("1100000001", "G1", at("17:00"), "0", "C3"),
        ("1100000001", "G1 old", at("16:00"), "1", "C3"),
    ],
    "melt_heat_event": [
        ("A", "AL018", at("10:12")),
        ("A", "AL018", at("10:15")),
        ("A", "AL021", at("10:35")),
        ("A", "MC026", at("10:50")),
        ("B", "ML01", at("12:05")),
        ("B", "MC026", at("12:50")),
        ("C", "AL059", at("14:30")),
        ("C", "AL062", at("14:20")),
        ("C", "MC026", at("14:45")),
        ("D", "AL018", at("2023-12-31 23:50")),
        ("D", "AL059", at("2024-01-01 00:05")),
        ("D", "AL021", at("2024-01-01 00:20")),
        ("D", "MC026", at("2024-01-01 00:40")),
        ("E", "ML26", at("16:30")),
        ("E", "AL021", at("16:10")),
        ("E", "MC026", at("16:50")),
        ("F", "MC026", at("16:50")),
        ("G", "MC026", at("16:50")),
        ("A", "XX000", at("23:00")),
        ("1100000001", "AL018", at("10:12")),
        ("1100000001", "AL021", at("10:30")),
    ],
    "l2_l3_heat_addition": [
        (1, 1, "LMS1", "A", at("10:11")),
        (2, 2, "LMS1", "A", at("10:16")),
        (3, 3, "LMS2", "A", at("10:21")),
        (4, 4, "VTD1", "A", at("10:31")),
        (11, 1, "LMS1", "1100000001 ", at("10:11")),
    ],
    "l2_l3_heat_addition_material": [
        (1, 1, "A", "Lime", 100.0, None),
        (2, 1, "A", "Lime", 50.0, None),
        (2, 2, "A", "Al Wire", None, 30.0),
        (3, 1, "A", "FeSi", 20.0, 0.0),
        (3, 2, "A", "Sand", 5.0, 0.0),
        (4, 1, "A", "Lime", 999.0, None),
        (11, 1, "1100000001", " MIX ", 7.0, None),
        (11, 2, "1100000001", None, 8.0, None),
    ],
    "l2_l3_chem_result": [
        (20, "LMS1", "A", at("10:00"), at("10:01"), 0, 1, 3),
        (30, "LMS1", "A", at("10:10"), at("10:11"), 0, 1, 3),
        (40, "LMS1", "A", at("10:20"), at("10:21"), 1, 1, 1),
        (50, "LMS1", "A", at("10:30"), at("10:31"), 0, 0, 1),
        (60, "CCM1", "A", at("10:40"), at("10:41"), 0, 1, 1),
        (70, "LMS1", "A", at("10:50"), at("10:51"), 0, 1, 0),
        (80, "LMS1", "1100000001", at("10:50"), at("10:51"), 0, 1, 1),
    ],
    "l2_l3_chem_result_element": [
        (20, 1, "C", 0.08),
        (20, 2, "Mn", 0.9),
        (20, 99, "Xx", 1.0),
        (30, 1, "C", 0.05),
        (30, 2, "Mn", None),
        (30, 3, "DI Value", 2.5),
        (40, 1, "C", 9.0),
        (50, 1, "C", 8.0),
        (60, 1, "C", 7.0),
        (80, 1, "C ", 0.07),
        (80, 5, "Cr", None),
    ],
    "l2_l3_message": [(n, f"M{n}", f"Message {n}", at("09:00")) for n in range(1, 9)],
    "l2_l3_parameter": [
        (1, "O2", 3.5, "ppm"),
        (2, "O2", 4.0, "ppm"),
        (3, "TEMP", 2900.0, "F"),
        (4, "TEMP_X", 1.0, "F"),
        (5, "CO2", 9.0, "ppm"),
        (6, "TEMP", None, "F"),
        (7, "O2", 5.0, "ppm"),
        (9, "O2", 99.0, "ppm"),
    ],
    "l2_l3_meas_result": [
        (1, "LMS1", "A", at("10:10"), "AUTO", "1", 1),
        (2, "XLMS", "A", at("10:20"), "AUTO", "1", 1),
        (3, "LMS1", "A", at("10:25"), "AUTO", "2", 1),
        (4, "LMS1", "A", at("10:30"), "AUTO", "3", 1),
        (5, "LMS1", "C", at("14:00"), "AUTO", "4", 1),
        (6, "LMS2", "B", at("12:00"), "AUTO", "2", 1),
        (7, "LMS1", "1100000001", at("10:20"), "AUTO", "1", 1),
        # No message row: the newest of heat A by time, but not part of the hub.
        (9, "LMS1", "A", at("23:00"), "AUTO", "1", 1),
    ],
    "l2_l3_heat_report_ccm": [
        ("CCM1", "1100000001", "O1", "G1"),
        ("CCM1", "1100000001", "O1", "G1"),
        ("CCM2", "1100000001", "O1", "G1"),
        ("CCM1", "1100000002", "O2", "G2"),
        ("CCM1", "1099999999", "O3", "G3"),
    ],
    "l2_l3_heat_report_lms": [
        (n, str(1100000000 + n), "LMS1", f"O{n}", at("10:00"), at("11:00"), 60.0, 1.0, 2.0, 3.0)
        for n in range(1, 8)
    ]
    + [(None, "1100000099", "LMS1", "O99", at("10:00"), at("11:00"), 60.0, 1.0, 2.0, 3.0)],
    "rpt_ref": [
        (n, "PL", n, at("10:05"), at("10:55"), *([float(n)] * 13), at("09:00"), 1.0, at("09:30"))
        for n in (1, 2, 3, 6, 6)
    ],
}


@pytest.fixture(scope="session")
def plant(spark):
    return SourceCatalog(
        {
            name: (lambda name=name: inline_rows(spark, SOURCES[name], GOLDEN[name]))
            for name in GOLDEN
        },
        # Some of its heat ids carry blanks.
        padded=SOURCES,
    )


def rows(df, *columns):
    """Sorted tuples of the named columns, nulls first."""
    picked = df.selectExpr(*[f"`{c}`" for c in columns]) if columns else df
    return sorted(
        (tuple(row) for row in picked.collect()),
        key=lambda row: [(value is not None, str(value)) for value in row],
    )

"""Wide process reports per melt batch ("heat"), computed as set-based Spark plans."""

from heatwright.plans.additions import additions_by_heat, additions_detail
from heatwright.plans.chemistry import chemistry, latest_chemistry
from heatwright.plans.heat_report import heat_report
from heatwright.plans.heat_sheet import heat_sheet
from heatwright.plans.incremental import run_incremental
from heatwright.plans.measurements import latest_measurement
from heatwright.plans.milestones import stir_ladle_times
from heatwright.plans.reference_report import last_heats, ref_report
from heatwright.plans.run import run_report
from heatwright.sources.catalog import SourceCatalog, heat_list

__all__ = [
    "SourceCatalog",
    "additions_by_heat",
    "additions_detail",
    "chemistry",
    "heat_list",
    "heat_report",
    "heat_sheet",
    "last_heats",
    "latest_chemistry",
    "latest_measurement",
    "ref_report",
    "run_incremental",
    "run_report",
    "stir_ladle_times",
]

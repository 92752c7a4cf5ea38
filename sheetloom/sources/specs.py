"""Which range of which sheet feeds which table."""

from dataclasses import dataclass, replace

from .ranges import column_letters, parse_range
from .sheets import CALENDAR_RANGE


@dataclass(frozen=True)
class SheetSpec:
    kind: str  # plan, forecast, lookup or range
    table: str
    sheet: str
    cells: str
    week_label: str | None = None
    city: str | None = None
    state: str | None = None
    calendar: str | None = None
    workbook: str | None = None  # the resource that listing and ledger know it by; the table's name if not given

    @property
    def resource(self) -> str:
        return self.workbook or self.table

    def resized(self, columns: int) -> "SheetSpec":
        """The same place on the sheet, ``columns`` wide and open at the bottom."""
        at = parse_range(self.cells)
        left = column_letters(at.first_col)
        right = column_letters(at.first_col + columns - 1)
        return replace(self, cells=f"{left}{at.first_row or 1}:{right}")


# The sources as they are configured.
PLAN_SPECS = [
    SheetSpec("plan", "Vert_SAN_Plan_FY2025", "Vert_SAN_Plan", "D2:ND1000", "DofW", "San Antonio", "Texas"),
    SheetSpec("plan", "Vert_STER_Plan_FY2025", "Vet_Ster_Plan", "D2:ND1000", "DofWk", "Sterling", "Virginia"),
    SheetSpec("plan", "Vert_SAN_Plan_FY2026", "Vert San Plan", "BN4:PN1000", "DoW", "San Antonio", "Texas"),
    SheetSpec("plan", "Vert_STER_Plan_FY2026", "Vert Ster Plan", "BK4:PK100", "DofWk", "Sterling", "Virginia"),
    SheetSpec("plan", "Vert_ALEX_Plan_FY2026", "Vert Alex Plan", "BL5:PL1000", "DofWk", "Alexandria", "Virginia"),
]
FORECAST_SPECS = [
    SheetSpec("forecast", "Forecast_SAN_FY2025", "Forecasts", "DJ1:EI1000", None, "San Antonio", "Texas", "A2193:B2556"),
    SheetSpec("forecast", "Forecast_STER_FY2025", "Forecasts", "BI1:DH1000", None, "Sterling", "Virginia", "A2193:B2556"),
    SheetSpec("forecast", "Forecast_SAN_FY2026", "Forecasts", "DP1:EP1000", None, "San Antonio", "Texas", CALENDAR_RANGE),
    SheetSpec("forecast", "Forecast_STER_FY2026", "Forecasts", "BK1:DN1000", None, "Sterling", "Virginia", CALENDAR_RANGE),
]
LOOKUP_SPEC = SheetSpec("lookup", "item_lookup", "Lookup Table", "B2:F1000")
RANGE_SPECS = [
    SheetSpec("range", "period_week", "Forecasts", "A2557:B"),
    SheetSpec("range", "period_month", "Forecasts", "BK:DN"),
]
CALENDAR_SHEET = "PdWks"
ALL_SPECS = PLAN_SPECS + FORECAST_SPECS + [LOOKUP_SPEC] + RANGE_SPECS

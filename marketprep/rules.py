"""Fixed values the two report jobs depend on.

Everything in this module is data, not logic: operators receive these
tables as parameters (and as small literal DataFrames), so a caller can
swap them without touching any plan.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the source reports' conventions)
# --------------------------------------------------------------------------

# Settlement report product sections, in the report order used by the jobs.
# (position, source report id, section header text, display name,
#  price column taken, transform, sink column)
PRODUCT_RULES: tuple[tuple[int, str, str, str, str, str, str], ...] = (
    (0, "STLBASIC_NYMEX_STLCPC_EOM_0", "26 Crude Oil Last Day Financial Futures",
     "WTI Crude Oil", "settlement", "none", "wti_crude_oil"),
    (1, "STLBASIC_NYMEX_STLCPC_EOM_0", "B0 Mont Belvieu LDH Propane (OPIS) Futures",
     "Propane", "settlement", "none", "propane"),
    (2, "STLBASIC_NYMEX_STLCPC_EOM_0", "BZ Brent Crude Oil Last Day Financial Futures",
     "Brent Crude Oil", "settlement", "none", "brent_crude_oil"),
    (3, "STLBASIC_NYMEX_STLCPC_EOM_0", "C0 Mont Belvieu Ethane (OPIS) Futures",
     "Ethane", "settlement", "none", "ethane"),
    (4, "STLBASIC_SETLCUR_EOM_SUM_0", "C1 Canadian Dollar/U.S. Dollar (CAD/USD) Futures",
     "US to CA$", "last", "reciprocal", "usd2cad"),
    (5, "STLBASIC_SETLCUR_EOM_SUM_0", "EC Euro/U.S. Dollar (EUR/USD) Futures",
     "Euro to $US", "last", "none", "euro2usd"),
    (6, "STLBASIC_NYMEX_EOM_SUM_0", "NG Henry Hub Natural Gas Futures",
     "Nat. Gas", "settlement", "none", "nat_gas"),
)

# Column names of a settlement report data line, in token order.
REPORT_COLUMNS: tuple[str, ...] = (
    "MTH_STRIKE", "DAILY_OPEN", "DAILY_HIGH", "DAILY_LOW", "DAILY_LAST",
    "SETT", "PNT_CHGE", "ACT_EST_VOL", "PREV_DAY_SETT", "PREV_DAY_VOL",
    "PREV_DAY_INT",
)
FULL_COLUMN_COUNT = 11
KEPT_COLUMN_COUNT = 6

# Ragged-line padding: token count -> [(after token index, empty cells)].
PADDING_RULES: dict[int, tuple[tuple[int, int], ...]] = {
    10: ((7, 1),),
    9: ((6, 1), (7, 1)),
    8: ((6, 1), (7, 2)),
}

# Line that closes a product section.
SECTION_FOOTER = "TOTAL"

# How the source jobs read a number: a leading dot becomes "0.", then the
# first unsigned number counts.
PARITY_LEADING_DOT = (r"^\.", "0.")
PARITY_NUMBER_PATTERN = r"(\d+\.?\d*)"

# Refinery series codes: capacity ("output" side) and gross input.
SERIES_UTILIZATION = "YUP"
SERIES_CAPACITY = "YRL"
SERIES_GROSS_INPUT = "EPXXX2"
SERIES_JOIN_KEYS: tuple[str, ...] = ("period", "duoarea", "area_name")
UTILIZATION_AREAS: tuple[str, ...] = ("U.S.", "PADD 3")
# Wide utilization row: display column order.
UTILIZATION_COLUMNS: tuple[str, ...] = ("Date", "U.S.", "PADD3")

# Faceted request: newest rows per series.
FACET_ROWS = 12
# Report lookback window in days.
LOOKBACK_DAYS = 7

# --------------------------------------------------------------------------
# Settings of this package (not taken from the source jobs)
# --------------------------------------------------------------------------

# Sink column types (declared DOUBLE, not FLOAT: FLOAT round-trips 32-bit).
SETTLEMENT_SINK_TYPES = ", ".join(f"{r[6]} DOUBLE" for r in PRODUCT_RULES)
UTILIZATION_SINK_TYPES = "Date DATE, `U.S.` DOUBLE, PADD3 DOUBLE"


@dataclass(frozen=True)
class PivotRule:
    """One output column of a rule-driven pivot."""

    position: int
    key: str          # value of the long table's name column
    column: str       # output column name
    price: str        # which value column to read
    transform: str    # "none" or "reciprocal"


def product_pivot_rules() -> list[PivotRule]:
    return [PivotRule(r[0], r[2], r[6], r[4], r[5]) for r in PRODUCT_RULES]


def products_by_source() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for r in PRODUCT_RULES:
        out.setdefault(r[1], []).append(r[2])
    return out

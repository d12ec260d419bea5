"""Values a business sets, as opposed to values the data gives."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Historical value classes: upper bounds (exclusive) in currency units.
    value_cuts: tuple[int, int, int] = (100, 300, 750)
    # Cadence bands in days: fast below the first, slow from the second.
    cadence_cuts: tuple[int, int] = (60, 120)
    # A city with fewer customers than this is reported with a caution.
    low_base_customers: int = 150
    # A behaviour cell with fewer customers than this is reported as low base.
    min_cell: int = 30
    breadth_strata: tuple[int, ...] = (3, 4, 5, 6)
    control_strata: tuple[int, ...] = (4, 6)
    # The two years compared in variance reports.
    variance_years: tuple[int, int] = (2024, 2025)
    # The three years set side by side in the regional growth report.
    growth_years: tuple[int, int, int] = (2023, 2024, 2025)
    # The three categories whose mix is reported, and the reason singled out.
    mix_categories: tuple[str, str, str] = ("Accessories", "Footwear", "Womenswear")
    driver_reason: str = "Wrong Size"
    high_return_category: str = "Footwear"
    # Only orders of this status count; None counts every order.
    order_status: str | None = None
    # Order frequency from which a mature cohort counts, in months.
    repeat_days: int = 90

    @property
    def value_cuts_c(self) -> tuple[int, int, int]:
        return tuple(100 * v for v in self.value_cuts)  # type: ignore[return-value]


# Fits the order tables the registered queries run on: lifetime values there lie
# around two million and gaps between orders around seven months.
RETAIL_PARAMS = Params(
    value_cuts=(1_000_000, 2_000_000, 3_000_000),
    cadence_cuts=(180, 280),
    low_base_customers=55,
    variance_years=(1999, 2000),
    growth_years=(1995, 1996, 1997),
    mix_categories=("ECONOMY", "LARGE", "PROMO"),
    high_return_category="STANDARD",
)

"""Every report and job by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from merchlens.params import Params
from merchlens.plans import (
    behaviour,
    certification,
    clv,
    cohorts,
    concentration,
    executive,
    geography,
    marketing,
    model,
    portfolio,
    product,
    quality,
    retention,
    returns,
    revenue,
    rfm,
    star_rules,
    verdicts,
)
from merchlens.sources.star import Star

Plan = Callable[[Star, Params], DataFrame]

_MODULES = (
    executive, revenue, product, geography, marketing, retention, returns, rfm, cohorts, clv, concentration,
    behaviour, portfolio,
)
# Shared helpers of the modules above that are no reports of their own.
_HELPERS = {"category_totals", "category_returns", "customer_orders", "mix_columns", "top_decile_group"}


def analytics() -> dict[str, Plan]:
    """Public functions of the report modules, in module order."""
    found: dict[str, Plan] = {}
    for module in _MODULES:
        for name, item in vars(module).items():
            own = callable(item) and getattr(item, "__module__", "") == module.__name__
            if own and not name.startswith("_") and name not in _HELPERS:
                found[name] = item
    return found


def registered() -> dict[str, Plan]:
    return {**analytics(), **model.JOBS, **quality.OPERATORS, **certification.SUITES, **star_rules.SUITES, **verdicts.VERDICTS}

"""Import every module that registers queries."""

from farmledger.plans import (  # noqa: F401
    aggregates,
    costing_queries,
    costs,
    dimension_catalog,
    dimension_specs,
    dimensions,
    division_month,
    finance,
    hatchery,
    house_climate,
    incremental,
    indicators,
    journal_extracts,
    loads,
    production_details,
    production_periods,
    production_queries,
    scalars,
    selections,
    shapes,
    windows,
)
from farmledger.plans.registry import REGISTRY

__all__ = ["REGISTRY"]

"""Importing this module registers every query."""

from fieldmart.plans import (  # noqa: F401
    climate_queries,
    crop_queries,
    market_queries,
    quality_queries,
    scenario_queries,
    source_queries,
    text_queries,
)

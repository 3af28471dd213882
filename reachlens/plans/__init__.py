"""Registered queries (name -> Spark query, name -> DuckDB oracle SQL)."""

from reachlens.plans import (  # noqa: F401  (importing registers the queries)
    catalog_causal, catalog_cohorts, catalog_features, catalog_forecast, catalog_kpi, catalog_models)
from reachlens.plans.registry import HEADLINE, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "HEADLINE"]

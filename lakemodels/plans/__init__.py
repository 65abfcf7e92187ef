"""Registered queries by theme; importing this package fills the registry."""

from lakemodels.plans import analytics, flagship, incremental, publishing, relational, values
from lakemodels.plans.registry import PLANS, SQL

__all__ = ["PLANS", "SQL", "analytics", "flagship", "incremental", "publishing", "relational", "values"]

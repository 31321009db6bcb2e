"""Queries over the star-schema tables, by family."""

from haulmetrics.plans import (cost_queries, metric_queries, model_queries, place_queries,  # noqa: F401
                               prep_queries, run_queries)
from haulmetrics.plans.registry import ORACLES, QUERIES  # noqa: F401

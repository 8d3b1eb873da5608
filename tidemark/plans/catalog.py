"""All registered queries."""

from . import (  # noqa: F401
    cluster_queries, fit_checks, funnel_queries, metric_queries, model_queries, series_queries,
    statistics_queries, text_queries,
)
from .registry import QUERIES, SQL  # noqa: F401

"""Data-quality metrics on Spark tables and streams."""

from dqspark.operators.indicators import evaluate_definitions, indicator_query, indicator_series
from dqspark.operators.profile import profile
from dqspark.operators.rollup import rollup_metrics
from dqspark.operators.series import metric_series
from dqspark.session import build_session
from dqspark.sources.readers import read_dataset

__all__ = [
    "build_session",
    "evaluate_definitions",
    "indicator_query",
    "indicator_series",
    "metric_series",
    "profile",
    "read_dataset",
    "rollup_metrics",
]

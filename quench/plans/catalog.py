"""All registered queries: importing this module imports every module that registers some."""

from quench.plans import (  # noqa: F401
    queries_clean, queries_experiments, queries_features, queries_io, queries_metrics, queries_models, queries_streaming,
)
from quench.plans.registry import QUERIES, Query, register  # noqa: F401

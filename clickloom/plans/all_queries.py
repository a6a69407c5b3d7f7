"""Imports every module that registers queries."""

from . import aggregate_queries, bitmap_queries, drift_test_queries, intake_queries, item_queries, list_queries, monitor_queries, recommend_queries, runner_queries, service_queries, stream_queries, timed_queries  # noqa: F401
from .registry import CHECKS, QUERIES  # noqa: F401

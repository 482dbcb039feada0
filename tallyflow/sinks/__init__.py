"""Sinks: the key -> value metrics table (K1-K4)."""

from tallyflow.sinks.metrics_store import MetricsTable, lookup_metrics, metrics_rows, remove_metrics

__all__ = ["MetricsTable", "lookup_metrics", "metrics_rows", "remove_metrics"]

"""Device telemetry on Spark: JSON readings to wide records, window statistics and health reports."""

from millrace.catalog import STATISTICS, WIND_FARM, Layout, Metric, MetricCatalog

__all__ = ["STATISTICS", "WIND_FARM", "Layout", "Metric", "MetricCatalog"]

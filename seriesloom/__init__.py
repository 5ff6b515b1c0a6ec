"""seriesloom: feature, backtest and forecast work on panels of time series, on Spark."""

from seriesloom.operators.panel import Panel

__all__ = ["Panel"]

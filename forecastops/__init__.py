"""Weekly sales forecasting data and forecast-model monitoring as plain Spark DataFrame operators."""

__version__ = "0.1.0"

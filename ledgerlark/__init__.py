"""Risk analytics for portfolios of overdue accounts, as composable Spark DataFrame operators."""

__version__ = "0.1.0"
